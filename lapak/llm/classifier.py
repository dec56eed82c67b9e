"""Quality of documents: a classifier's evidence with what their site is known for.

A logistic regression on hashed words and word pairs and on counts of the text gives each document
a probability. Sites have two levels, host and path. A host's share of good documents is its
expected number of them, shrunk towards the global share; a path's is shrunk towards its host's:
both by beta priors whose weight is estimated from how much the shares differ (empirical Bayes). A
sparse site says little, a large one speaks for itself. The document's log odds and its site's, less
the global ones, add up; what the site is known for is taken without the document itself, so no
document counts twice and a lone one has its own evidence only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import WORD, written

#: Labelled documents used for training, at most on average (a share of the labels by hash).
SAMPLE = 50_000
#: Weights of a prior, in documents, are kept within these.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 10_000.0
KEEP = 0.5
#: Probabilities are held this far from 0 and 1.
EDGE = 1e-4
SYMBOLS = r"[#*$%&|<>]"
#: Width of the hashed words and of the hashed pairs, and the strength of the penalty on weights.
HASHED, PENALTY = 1 << 14, 1e-4
COUNTED = ("words", "short", "word_length", "symbols", "numbers", "stops", "variety", "line_variety")


def features(text: Column) -> list[Column]:
    """Counts of a text on scales a linear model can use."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    n = F.greatest(F.size(words), F.lit(1)).cast("double")
    share = lambda pattern: F.regexp_count(t, F.lit(pattern)) / n
    lines = F.split(t, "\n")
    return [
        F.log1p(F.size(words)).alias("words"),
        F.least(F.size(words), F.lit(50)).cast("double").alias("short"),
        (F.length(t) / n).alias("word_length"),
        F.log1p(10 * share(SYMBOLS)).alias("symbols"),
        share("[0-9]+").alias("numbers"),
        share("[.!?]").alias("stops"),
        (F.size(F.array_distinct(words)) / n).alias("variety"),
        (F.size(F.array_distinct(lines)) / F.size(lines)).alias("line_variety"),
    ]


def _measured(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep``, the words of each text in small letters (``tokens``) and its counts."""
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_extract_all(F.lower(t), F.lit(WORD), F.lit(0)).alias("tokens_")
    return docs.select(*keep, F.col("doc_id").alias("id_"), words, *[c.alias(f"f_{n}") for c, n in zip(features(F.col("text")), COUNTED)])


def _stages() -> list:
    """Counts, hashed words and hashed pairs as one sparse vector of fixed width.

    A word counts once per text, and both hashed parts have length 1, so a long text weighs no more.
    """
    out = [NGram(n=2, inputCol="tokens_", outputCol="pairs_")]
    for name in ("tokens_", "pairs_"):
        out.append(HashingTF(numFeatures=HASHED, binary=True, inputCol=name, outputCol=f"{name}hashed"))
        out.append(Normalizer(inputCol=f"{name}hashed", outputCol=f"{name}unit"))
    return [*out, VectorAssembler(inputCols=[*[f"f_{n}" for n in COUNTED], "tokens_unit", "pairs_unit"], outputCol="vector_")]


def document_evidence(docs: DataFrame, labels: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns of ``docs`` with ``p_document``: the classifier's probability of good.

    A document's label is the majority of its rows in ``labels``, a tie or NULL is none. Without
    labels of both kinds the probability is the share of good labels, (good + 1) / (all + 2).
    Vectors are made as they are needed, of labelled texts to train and of all texts to judge, and
    not stored.
    """
    vote = F.avg(F.col("quality").cast("double"))
    voted = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(vote.alias("vote"))
    known = written(voted.where("vote != 0.5").select(F.col("doc_id").alias("of"), (F.col("vote") > 0.5).cast("double").alias("label")), "labels")
    parts = 1 << 20
    met = docs.select(F.col("doc_id").alias("of")).join(known, "of")
    n, good = met.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < good < n:
        return docs.select(*keep, F.lit((good + 1) / (n + 2)).alias("p_document"))
    chosen = known.where(F.pmod(F.xxhash64(F.lit(5), "of"), F.lit(parts)) < int(min(1.0, SAMPLE / n) * parts))
    labelled = docs.join(chosen, F.col("doc_id") == F.col("of")).select("doc_id", "text", "label")
    train = written(_measured(labelled, ("label",)), "training")
    # Features keep their scale: a rare word is a small number and stays a weak one.
    model = LogisticRegression(
        featuresCol="vector_", labelCol="label", probabilityCol="odds_", rawPredictionCol="raw_", predictionCol="said_", regParam=PENALTY, maxIter=60, standardization=False,
    )
    fitted = Pipeline(stages=[*_stages(), model]).fit(train)
    # Read back, the model is without its training summary, which holds the session: where a write was
    # observed before, that cannot be sent to the tasks.
    path = scratch_folder(train.sparkSession, "model")
    fitted.write().save(path)
    fitted = PipelineModel.load(path)
    return fitted.transform(_measured(docs, keep)).select(*keep, vector_to_array("odds_")[1].alias("p_document"))


def _weight(mean: Column, shares: Column, n: Column) -> list[Column]:
    """Aggregates from which a prior's weight follows: spread of shares against chance alone."""
    return [F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.sum(n * (shares - mean) ** 2).alias("spread"), F.count(F.lit(1)).alias("k")]


def _prior_weight(mean: Column) -> Column:
    """Documents a prior counts for: mean (1 - mean) over the variance between sites, less one.

    The spread of the sites' shares, less what chance in n documents makes, is that variance.
    """
    chance = mean * (1 - mean)
    between = (F.col("spread") - F.col("k") * chance) / F.greatest(F.col("n") - F.col("nn") / F.col("n"), F.lit(1.0))
    weight = F.when(between > 0, chance / between - 1).otherwise(MOST_WEIGHT)
    return F.least(F.greatest(F.coalesce(weight, F.lit(MOST_WEIGHT)), F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """host, path, p_host, p_path of every site, and the global share; with them n and good documents
    of host and path and the weights of both priors, from which one document can be left out.

    ``evidence`` has host, path and p_document. Documents are summed per path before anything is
    moved, so a host with a third of all documents is as many rows as it has paths.
    """
    paths = written(evidence.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n_path"), F.sum("p_document").alias("good_path")), "paths")
    hosts = written(paths.groupBy("host").agg(F.sum("n_path").alias("n_host"), F.sum("good_path").alias("good_host")), "hosts")
    n, good = hosts.agg(F.sum("n_host"), F.sum("good_host")).first()
    if not n:
        none = [F.lit(0.5).alias(c) for c in ("p_host", "p_path", "n_host", "good_host", "host_weight", "path_weight")]
        return paths.select("host", "path", "n_path", "good_path", *none), 0.5
    overall = min(max(good / n, EDGE), 1 - EDGE)
    mean = F.lit(overall)
    spread = hosts.agg(*_weight(mean, F.col("good_host") / F.col("n_host"), F.col("n_host")))
    host_weight = spread.select(_prior_weight(mean)).first()[0]
    shrunk = hosts.select(F.col("host").alias("host_"), "n_host", "good_host", ((F.col("good_host") + host_weight * mean) / (F.col("n_host") + host_weight)).alias("p_host"))
    both = written(paths.join(shrunk, F.col("host").eqNullSafe(F.col("host_"))).drop("host_"), "sites")
    within = both.agg(*_weight(F.col("p_host"), F.col("good_path") / F.col("n_path"), F.col("n_path")))
    path_weight = within.select(_prior_weight(mean)).first()[0]
    p_path = (F.col("good_path") + path_weight * F.col("p_host")) / (F.col("n_path") + path_weight)
    weights = [F.lit(w).cast("double").alias(n) for n, w in (("host_weight", host_weight), ("path_weight", path_weight))]
    counts = ["n_host", "good_host", "n_path", "good_path"]
    return written(both.select("host", "path", "p_host", p_path.alias("p_path"), *counts, *weights), "posteriors"), overall


def without_itself(overall: float) -> Column:
    """The path's posterior without the document of the row: its site as its other documents show it."""
    own = F.col("p_document")
    host = (F.col("good_host") - own + F.col("host_weight") * F.lit(overall)) / (F.col("n_host") - 1 + F.col("host_weight"))
    return (F.col("good_path") - own + F.col("path_weight") * host) / (F.col("n_path") - 1 + F.col("path_weight"))


def _log_odds(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(held / (1 - held))


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """doc_id, p_document, p_host, p_path, p_good, kept of every document.

    NULL is a host and a path of its own; NULL and empty texts are classified by their counts,
    which are zero.
    """
    placed = docs.select(F.col("doc_id"), F.col("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    evidence = written(document_evidence(placed, labels, ("doc_id", "host", "path")), "evidence")
    sites, overall = site_posteriors(evidence)
    named = sites.withColumnsRenamed({"host": "h", "path": "p"})
    joined = evidence.join(named, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")), "left")
    odds = _log_odds(F.col("p_document")) + _log_odds(without_itself(overall)) - _log_odds(F.lit(overall))
    good = 1 / (1 + F.exp(-odds))
    return joined.select("doc_id", "p_document", "p_host", "p_path", good.alias("p_good"), (good >= KEEP).alias("kept"))


def classify_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents by source (the host) and language within it (the path)."""
    return classify(docs, labels, F.col("source"), F.col("lang"))
