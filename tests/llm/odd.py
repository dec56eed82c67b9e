"""Awkward documents: NULLs, empty and very long texts, ties, repeated rows, clashing columns."""

import random
import re

WORD = re.compile(r"[^\x20\t-\r]+")
# Names that operators use inside must not disturb them.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "size string, hash string, piece string, place string, shard int, row_number int, uid string, "
    "kept boolean, spans string, n bigint, pool string, fingerprint string, component string"
)
EXTRA = ("x", "y", "z", "p", 3, 4, "u", False, "s", 9, "q", "f", "c")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(n))


def documents():
    rng = random.Random(5)
    rows = []
    for i in range(300):
        text = words(rng, rng.randint(1, 120))
        if i % 7 == 0:
            text = text.replace(" ", "\n", 5)
        source = "hot" if rng.random() < 0.4 else f"s{rng.randint(0, 9)}"
        rows.append((i, text, rng.choice(["en", "de"]), source))
    copies = words(rng, 80)
    rows += [(400 + i, copies, "en", "hot") for i in range(60)]  # a group of copies
    rows += [(500 + i, copies + f" tail{i}", "en", "hot") for i in range(20)]  # near copies
    rows += [(600, words(rng, 30_000), "en", "s1"), (601, "x" * 200_000, "en", "s2")]  # very long
    rows += [(602, "", "en", "s1"), (603, None, "en", "s1"), (604, " \n\t ", None, None)]
    rows += [(605, "ünïcode \U0001f600 wörds nbsp\x1cseparator", "fr", None)]
    rows += [(None, "no id here", None, None), (None, "no id here", None, None), (None, None, None, None)]
    rows += [(606, "the same row", "en", "s3")] * 3  # repeated rows
    rows += [(607, "an id", "en", "s4"), (607, "twice", "en", "s4")]
    return [(*r, len(r[1]) if r[1] is not None else None, *EXTRA) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)


def stored(spark, tmp_path, rows=None):
    """A data folder whose ``documents`` are the awkward ones."""
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)
