"""Personal data by patterns, and the terms that give it away by corpus co-occurrence.

An e-mail address, network address, card or phone number is a protected entity. Every term of a
document that holds an entity is held against the corpus: with N documents, d(e) and d(t) of them
holding the entity and the term, and d(e, t) holding both, wherever they stand,

    information of the entity      I(e) = log2(N / d(e))
    disclosure of it by the term   D(e, t) = log2(N d(e, t) / (d(e) d(t))) <= I(e)

Few different texts are weak evidence, so the share d(e, t) / d(t) counts with the lower end of its
confidence interval. A term whose disclosure reaches a share of the entity's information would tell
the entity to anyone who knows the corpus, even with the entity itself masked. Wherever it stands in a document
with the entity it is replaced by its class (number, name, word) if the class discloses less than
the threshold, and removed otherwise. Documents that do not hold the entity keep the term: the rule is
per document, since there it gives nothing away that the document holds.

Entities that stand in the same texts have the same counts with every term and are one group, so a
text full of addresses is no product of addresses and words.
Everything here is built-in expressions, joins and aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

# The patterns find what the plain ones do, leftmost and not overlapping, in linear time: a match
# can only start where a run of its characters starts or where the last match ended, and nothing
# is tried twice. A card's run of digits is matched only when it is whole and of the right length.
_LOCAL = r"A-Za-z0-9._%+-"
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match (checked first, since it is cheap).
_NEEDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: F.contains(t, F.lit(".")),
    "card": lambda t: F.lit(True),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
#: Terms of any length: names have two letters, or one in scripts without blanks.
WORDS = r"[\p{L}\p{N}]++"
#: Words of a text that are placed in one piece.
BLOCK = 128
#: Terms, and bytes of them, that are sent to all tasks to be looked for; more are counted otherwise.
SENT, SENT_BYTES = 500_000, 16_000_000
#: Share of an entity's information a term may disclose, and the normal quantile of the one-sided
#: 90 % interval of what few texts show.
DISCLOSED, SURE = 0.85, 1.2815515655446004
CLASSES = {"NUMBER": r"\p{N}", "NAME": r"(?<![\p{L}\p{N}])\p{Lu}", "WORD": r"(?<![\p{L}\p{N}])[\p{L}&&[^\p{Lu}]]"}
_PLACE = "struct<start:int,end:int,value:string>"


def _place(held: Column, pair: Column) -> Column:
    """``held`` (at, out) with the match of a (gap, value) added."""
    start = held["at"] + F.length(pair["gap"])
    end = start + F.length(pair["value"])
    return F.struct(
        end.alias("at"),
        F.concat(held["out"], F.array(F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value")))).alias("out"),
    )


def _pairs(text: Column, pattern: str) -> Column:
    """Array of (gap, value): a pattern's matches, each with the text between it and the one before."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("gap"), found.alias("value"))


def _nothing(kind: str) -> Column:
    return F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out"))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of a pattern's matches, in code points, end exclusive.

    The text between matches and the matches themselves alternate; running lengths are the places.
    """
    return F.aggregate(_pairs(text, pattern), _nothing(_PLACE), _place, lambda held: held["out"])


def words_at(text: Column) -> Column:
    """``matches`` of all words. They are placed block by block, as adding to a long array copies it."""

    def moved(block: Column, by: Column) -> Column:
        return F.transform(block, lambda m: F.struct((m["start"] + by).alias("start"), (m["end"] + by).alias("end"), m["value"].alias("value")))

    def follow(held: Column, block: Column) -> Column:
        return F.struct((held["at"] + block["at"]).alias("at"), F.concat(held["out"], F.array(moved(block["out"], held["at"]))).alias("out"))

    def whole(pairs: Column) -> Column:
        last = F.greatest(F.floor((F.size(pairs) - 1) / BLOCK).cast("int"), F.lit(0))
        blocks = F.transform(F.sequence(F.lit(0), last), lambda b: F.aggregate(F.slice(pairs, b * BLOCK + 1, F.lit(BLOCK)), _nothing(_PLACE), _place))
        return F.flatten(F.aggregate(blocks, _nothing(f"array<{_PLACE}>"), follow, lambda held: held["out"]))

    # As an argument the pairs are made once, not for every block.
    return F.transform(F.array(_pairs(text, WORDS)), whole)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled and cast out, sums to a multiple of 10."""

    def step(total: Column, i: Column) -> Column:
        digit = digits.substr(F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = digit * 2
        folded = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(i % 2 == 0, folded).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


_HOLDS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda v: luhn(_digits(v)),
    "phone": lambda v: F.length(_digits(v)).between(8, 15),
}


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end, value): by kind as listed, then by start. NULL text: empty."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def of(kind: str) -> Column:
        kept = F.filter(matches(text, PATTERNS[kind]), lambda m: _HOLDS[kind](m["value"]))
        named = F.transform(kept, lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))
        return F.when(F.coalesce(_NEEDS[kind](text), F.lit(False)), named).otherwise(none)

    return F.concat(*map(of, KINDS))


def _term_class(value: Column) -> Column:
    return F.when(value.rlike(r"\p{N}"), "NUMBER").when(value.rlike(r"^\p{Lu}"), "NAME").otherwise("WORD")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def lowered(text: Column) -> Column:
    """Lower case, the same for a word as for the text around it: no letter becomes two, and there
    is one small sigma."""
    return F.replace(F.lower(F.replace(text, F.lit("İ"), F.lit("i"))), F.lit("ς"), F.lit("σ"))


def terms_of(text: Column) -> Column:
    """The different terms of a text."""
    return F.array_distinct(F.regexp_extract_all(lowered(text), F.lit(WORDS), F.lit(0)))


def certain(held: Column, of: Column) -> Column:
    """Lower end of Wilson's interval for the share ``held`` / ``of``, as a part of that share.

    It falls as ``of`` grows and nears 1 as both do.
    """
    share, z2 = held / of, SURE * SURE
    half = SURE * F.sqrt(share * (1 - share) / of + z2 / (4 * of * of))
    return (share + z2 / (2 * of) - half) / (1 + z2 / of) / share


def scan(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """text_id, base (spans), entities (different ones) and text of every row, written.

    ``entities`` and ``text`` are NULL where no entity is.
    ``text_id`` is the text's hash: what is found depends on the text alone.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    based = docs.select(*keep, F.unhex(F.sha2(text, 256)).alias("text_id"), text.alias("text"), base_spans(text).alias("base"))
    entities = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(" "), F.lower(s["value"]))))
    some = F.size("base") > 0
    return written(
        based.select(*keep, "text_id", "base", F.when(some, entities).alias("entities"), F.when(some, F.col("text")).alias("text")),
        "scanned",
    )


def _disclosure(n_docs: int, d_both: Column, texts: Column, d_entity: Column, d_term: Column, t_term: Column) -> Column:
    """Disclosure by documents with both, with the entity and with the term, and by texts with both and with the term.

    Both factors fall as documents and texts that hold the term are added.
    """
    return F.log2(n_docs * d_both / (d_entity * d_term) * certain(texts, t_term))


def _entries(text: Column) -> Column:
    """Array of (term, class): the different terms of a text with the least of their classes.

    Sorted by term and class, the first of equal terms stays: all of it inside the row.
    """
    words = F.array_distinct(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)))
    found = F.array_sort(F.transform(words, lambda w: F.struct(lowered(w).alias("term"), _term_class(w).alias("class"))))
    # As an argument the entries are sorted once, not for every element.
    return F.transform(F.array(found), lambda e: F.filter(e, lambda x, i: (i == 0) | (F.get(e, i - 1)["term"] != x["term"])))[0]


def entity_groups(scanned: DataFrame, n_docs: int) -> tuple[DataFrame, DataFrame]:
    """Entities with their group, and the groups of each text: text_id, group, d_entity, t_entity, limit.

    Entities are one group if the same texts hold them, told by two independent 64-bit sums over the
    texts' hashes, the number of texts and of documents. The documents and texts that hold one are
    d_entity and t_entity; an entity that all documents hold tells nothing and has no group.
    """
    slim = written(
        scanned.where(F.size("base") > 0).groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), F.first("entities").alias("entities")), "entities"
    )
    of_entity = slim.select("text_id", "n", F.explode("entities").alias("entity"))
    marks = [F.hex(F.bit_xor(F.xxhash64(F.lit(k), "text_id"))) for k in (1, 2)]
    counts = of_entity.groupBy("entity").agg(F.sum("n").alias("d_entity"), F.count(F.lit(1)).alias("t_entity"), F.concat_ws(":", *marks).alias("texts"))
    counts = counts.withColumn("limit", DISCLOSED * F.log2(F.lit(n_docs) / F.col("d_entity"))).where(F.col("limit") > 0)
    counts = written(counts.withColumn("group", F.concat_ws(":", "texts", "d_entity", "t_entity")).drop("texts"), "entity_counts")
    groups = of_entity.select("text_id", "entity").join(counts, "entity").select("text_id", "group", "d_entity", "t_entity", "limit").distinct()
    return counts.select("entity", "group"), written(groups, "entity_groups")


def together(scanned: DataFrame, n_docs: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The different texts with entities, their groups, their pairs of group and term that may disclose, and the entities.

    Texts have tid, text_id, n (documents with the text), text, base; pairs have tid, n, group,
    d_entity, limit, term, class, and d_term and t_term: the documents and texts with entities that
    hold the term, no more than all that hold it. Pairs whose disclosure is below the limit even by
    these, and with the term beside the entity as often as can be, are left out; they need not be
    counted, so no common word is. The bound depends on counts alone, so a term is first held
    against the different counts of its text's entities, and only what passes meets their groups.
    """
    entities, groups = entity_groups(scanned, n_docs)
    kinds = groups.groupBy("text_id").agg(F.collect_set(F.struct("d_entity", "t_entity", "limit")).alias("kinds"))
    texts = scanned.where(F.size("base") > 0).groupBy("text_id").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("text", "base")])
    texts = written(texts.join(kinds, "text_id", "left").withColumn("tid", F.monotonically_increasing_id()), "texts")
    groups = written(groups.join(texts.select("text_id", "tid", "n"), "text_id").drop("text_id"), "groups")
    terms = written(texts.select("tid", "n", "kinds", F.explode(_entries(F.col("text"))).alias("e")).select("tid", "n", "kinds", "e.term", "e.class"), "terms")
    # The share of the term's documents that hold the entity has to reach (d(e) / N) ** (1 - DISCLOSED),
    # and is d(e) / d(t) at most.
    most = (groups.agg(F.max("d_entity")).first()[0] or 0) * max(n_docs, 1) ** (1 - DISCLOSED) * (1 + 1e-9)
    held = terms.groupBy("term").agg(F.sum("n").alias("d_term"), F.count(F.lit(1)).alias("t_term"))
    held = written(held.where(F.col("d_term") <= most), "held_counts")

    def may(d_entity: Column, t_entity: Column, limit: Column) -> Column:
        d_term, t_term = F.col("d_term"), F.col("t_term")
        return _disclosure(n_docs, F.least(d_entity, d_term), F.least(t_entity, t_term), d_entity, d_term, t_term) >= limit

    near = terms.where("kinds is not null").join(held, "term").where(F.exists("kinds", lambda k: may(k["d_entity"], k["t_entity"], k["limit"])))
    pairs = near.drop("kinds", "n").join(groups, "tid").where(may(F.col("d_entity"), F.col("t_entity"), F.col("limit"))).drop("t_entity")
    return texts, groups, written(pairs, "pairs"), entities


def _held_by_all(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """term, d_all: the documents that hold each term of ``wanted`` (term, distinct)."""
    every = docs.select(F.explode(terms_of(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("term"))
    n, size = wanted.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    if n <= SENT and (size or 0) <= SENT_BYTES:
        return every.join(F.broadcast(wanted), "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("d_all"))
    # Summed before they meet the wanted ones, so each task sends a term once.
    return every.groupBy("term").agg(F.count(F.lit(1)).alias("d_all")).join(wanted, "term", "left_semi")


def _disclosing(docs: DataFrame, n_docs: int, texts: DataFrame, groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """group, term, replacement: the terms that disclose the entities of a group beyond the threshold."""
    # Copies count as documents, but not as different texts.
    both = pairs.groupBy("group", "term", "d_entity", "limit", "d_term", "t_term").agg(
        F.sum("n").alias("d_both"), F.count(F.lit(1)).alias("texts"), F.min("class").alias("class")
    )

    def reaching(rows: DataFrame) -> DataFrame:
        columns = [F.col(c) for c in ("d_both", "texts", "d_entity", "d_term", "t_term")]
        return rows.where(_disclosure(n_docs, *columns) >= F.col("limit"))

    candidates = written(reaching(both), "candidates")
    if candidates.isEmpty():
        return candidates.select("group", "term", F.col("class").alias("replacement"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    per_class = docs.agg(*[F.count(F.when(text.rlike(p), 1)) for p in CLASSES.values()]).first()
    all_held = _held_by_all(docs, written(candidates.select("term").distinct(), "wanted"))
    counted = candidates.join(all_held, "term").withColumns({"d_term": F.col("d_all"), "d_out": F.col("d_all") - F.col("d_term")})
    # The documents without entities that hold the term are between one text (or none) and as many
    # as they are. Only where that leaves the decision open are their different texts counted.
    fewest = F.col("t_term") + F.least("d_out", F.lit(1))
    open_ = written(reaching(counted.withColumn("t_held", F.col("t_term")).withColumn("t_term", fewest)), "open")
    open_ = open_.withColumn("t_term", F.col("t_held") + F.col("d_out"))
    sure = reaching(open_)
    unsure = written(open_.join(sure.select("group", "term"), ["group", "term"], "left_anti"), "unsure")
    known = sure.select("group", "term", "class", "d_entity", "limit")
    if not unsure.isEmpty():
        hashed = docs.select(F.unhex(F.sha2(text, 256)).alias("text_id"), text.alias("text"))
        rows = hashed.select("text_id", F.explode(terms_of(F.col("text"))).alias("term")).join(unsure.select("term").distinct(), "term", "left_semi")
        t_all = rows.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("t_all"))
        exact = reaching(unsure.join(t_all, "term").withColumn("t_term", F.col("t_all")))
        known = known.unionByName(exact.select("group", "term", "class", "d_entity", "limit"))
    classes = F.filter(F.array(*[F.when(F.col("text").rlike(p), F.lit(c)) for c, p in CLASSES.items()]), lambda c: c.isNotNull())
    with_class = texts.select("tid", classes.alias("classes")).select("tid", F.explode("classes").alias("class"))
    d_class = with_class.join(groups.select("tid", "group", "n"), "tid").groupBy("group", "class").agg(F.sum("n").alias("d_both_class"))
    total = F.array(*[F.lit(int(c)) for c in per_class])
    position = F.array_position(F.array(*[F.lit(c) for c in CLASSES]), F.col("class")).cast("int")
    by_class = F.log2(n_docs * F.col("d_both_class") / (F.col("d_entity") * F.greatest(F.element_at(total, position), F.lit(1))))
    replacement = F.when(by_class < F.col("limit"), F.col("class")).otherwise(F.lit(""))
    known = known.join(written(d_class, "class_counts"), ["group", "class"])
    return written(known.select("group", "term", replacement.alias("replacement")), "disclosing")


def disclosing(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """entity, term, replacement: the terms that disclose an entity beyond the threshold.

    Probabilities are shares of all documents. ``replacement`` is the class, or empty to remove.
    """
    n_docs = docs.count()
    texts, groups, pairs, entities = together(scanned, n_docs)
    return entities.join(_disclosing(docs, n_docs, texts, groups, pairs), "group").select("entity", "term", "replacement")


def term_spans(docs: DataFrame, scanned: DataFrame) -> DataFrame:
    """text_id, terms (kind, start, end, value: the replacement) of texts with disclosing terms."""
    n_docs = docs.count()
    texts, groups, pairs, _ = together(scanned, n_docs)
    hits = pairs.join(_disclosing(docs, n_docs, texts, groups, pairs), ["group", "term"])
    # For two entities a term is one span; removing goes before generalising.
    hits = written(hits.groupBy("tid", "term").agg(F.min("replacement").alias("replacement")), "hits")
    placed = texts.join(hits.select("tid").distinct(), "tid", "left_semi").select("tid", F.explode(words_at(F.col("text"))).alias("t"))
    hit = placed.select("tid", "t", lowered(F.col("t.value")).alias("term")).join(hits, ["tid", "term"])
    span = F.struct(F.lit(TERM).alias("kind"), F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("replacement").alias("value"))
    spans = hit.groupBy("tid").agg(F.sort_array(F.collect_list(span)).alias("terms")).join(texts.select("tid", "text_id", "base"), "tid")
    outside = F.filter("terms", lambda t: ~F.exists("base", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return written(spans.select("text_id", outside.alias("terms")), "term_spans")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every document.

    NULL texts are empty. Spans of the method have the kind ``term`` and stand last.
    """
    narrow = docs.select("doc_id", "text")
    scanned = scan(narrow, ("doc_id",))
    terms = term_spans(narrow, scanned).withColumnRenamed("text_id", "of")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    # Only rows that hold an entity are moved to meet their terms.
    with_terms = scanned.where(F.size("base") > 0).select("doc_id", "text_id", "base").join(terms, F.col("text_id") == F.col("of"), "left")
    rows = scanned.where(F.size("base") == 0).select("doc_id", "base", none.alias("terms")).unionByName(with_terms.select("doc_id", "base", "terms"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", F.coalesce("terms", none))).alias("spans"),
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans, sorted by start, replaced by ``[VALUE]``; overlapping ones are one.

    A span with an empty value is taken out.
    """

    def step(held: Column, s: Column) -> Column:
        label = F.when(s["value"] == "", F.lit("")).otherwise(F.concat(F.lit("["), s["value"], F.lit("]")))
        between = F.substring(text, held["at"] + 1, s["start"] - held["at"])
        fresh = s["start"] >= held["at"]
        return F.struct(
            F.greatest(held["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(held["out"], between, label)).otherwise(held["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda held: F.concat(held["out"], F.substring(text, held["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with entities masked by their kind, and disclosing terms generalised or removed.

    Other columns stay; ``n_chars``, if there, becomes the new length. Texts without entities, and
    NULL texts, are unchanged.
    """
    wide = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all")
    scanned = scan(docs.select(wide, "text"), ("all",))
    terms = term_spans(docs.select("text"), scanned).withColumnRenamed("text_id", "of")
    # Only texts that hold an entity are moved to meet their terms.
    touched = scanned.where(F.size("base") > 0).join(terms, F.col("text_id") == F.col("of"), "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    masks = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.upper(s["kind"]).alias("value")))
    added = F.transform(F.coalesce("terms", none), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    changed = F.col("all").withField("text", masked(F.col("all.text"), F.sort_array(F.concat(masks, added))))
    changed = touched.select(changed.alias("all")).select("all.*")
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return scanned.where(F.size("base") == 0).select("all.*").unionByName(changed)
