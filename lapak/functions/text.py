"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_col


def delete(column: Column | str, *pieces: str) -> Column:
    """Remove every literal occurrence of each piece."""
    column = as_col(column)
    for piece in pieces:
        column = F.replace(column, F.lit(piece), F.lit(""))
    return column


def keep_alphanumeric(column: Column | str, also: str = "") -> Column:
    """Remove every character but ASCII letters, digits and the given extra class members."""
    return F.regexp_replace(as_col(column), f"[^a-zA-Z0-9{also}]", "")


def part_of(column: Column | str, separator: str, index: int) -> Column:
    """Element ``index`` (from 0) of a split on a literal separator; NULL when too short."""
    return F.get(F.split(as_col(column), _literal(separator)), F.lit(index))


def _literal(text: str) -> str:
    special = set("\\.[]{}()*+-?^$|")
    return "".join("\\" + ch if ch in special else ch for ch in text)


def title_case(column: Column | str) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the others.

    ``initcap`` looks at white space only and would leave ``dki-jakarta`` as ``Dki-jakarta``.
    """
    words = F.split(F.lower(as_col(column)), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))),
        "",
    )


def unquote(column: Column | str) -> Column:
    """The text between the first two double quotes, or the text itself where there are none."""
    column = as_col(column)
    return F.when(column.contains('"'), part_of(column, '"', 1)).otherwise(column)


def whole_number(column: Column | str, prefix: str = "") -> Column:
    """``"IDR 1.234.000"`` to 1234000: dots group thousands; bad text becomes NULL."""
    column = as_col(column).cast("string")
    if prefix:
        column = delete(column, prefix)
    return F.trim(delete(column, ".")).try_cast("bigint")


def phone(column: Column | str) -> Column:
    """Digits and letters only, country code 62 to a leading 0, too short numbers masked."""
    clean = keep_alphanumeric(F.coalesce(as_col(column), F.lit("")))
    local = F.when(clean.startswith("62"), F.concat(F.lit("0"), F.substr(clean, F.lit(3)))).otherwise(clean)
    zero = F.when(~local.startswith("0"), F.concat(F.lit("0"), local)).otherwise(local)
    return F.when(F.length(zero) < 10, F.lit("*******")).otherwise(zero)


def postcode(column: Column | str) -> Column:
    return delete(F.coalesce(as_col(column).cast("string"), F.lit("")), ".0", "'", "None")


def clean_address(column: Column | str) -> Column:
    """Line breaks to a comma, non-breaking blanks removed."""
    column = F.replace(as_col(column), F.lit(" \n"), F.lit(" "))
    column = F.replace(column, F.lit("\n"), F.lit(", "))
    return delete(column, "\u00a0")


def zero_toggle(column: Column | str) -> Column:
    """Strip one leading zero, or add one where there is none."""
    column = as_col(column)
    return F.when(column.startswith("0"), F.substr(column, F.lit(2))).otherwise(
        F.concat(F.lit("0"), column)
    )
