"""Quality rules: surface counts, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Only DataFrame functions. Words and word pairs are hashed into a fixed number of buckets; two multinomials over the
buckets, one of trusted documents and one of the whole corpus, give a weight per bucket. A document's score is its
mean weight, so it does not depend on length, and every document is held against one fixed threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import bounded_sample, let, words

BUCKETS = 1 << 15
#: Mean log ratio (natural) below which a document is taken for raw rather than trusted text.
THRESHOLD = -0.13

_BLANKS = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _chain(a: Column, b: Column) -> Column:
    """Hashes of the elements of ``a`` followed by those of ``b``, position by position."""
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def _from(a: Column, start: int) -> Column:
    return F.slice(a, start, F.greatest(F.size(a), F.lit(1)))


def _covered(hashes: Column) -> Column:
    """Words inside windows (given by their hashes, five words each) that are found twice or more, the first included."""
    def repeated(s: Column) -> Column:
        twin = lambda k, x: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        marked = F.transform(s, lambda x, k: F.when(twin(k - 1, x) | twin(k + 1, x), x["i"]))
        return let(F.sort_array(F.array_compact(marked)), span)

    def span(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - x, F.lit(5))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(let(ranked, repeated))


def surface_counts(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``doc``, with ``w`` (words) and the counts that the base rules use."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(_BLANKS)) != "")
    without = text
    for symbol in _SYMBOLS:
        without = F.replace(without, F.lit(symbol), F.lit(""))
    return docs.select(
        F.struct("*").alias("doc"), words(text).alias("w"),
        (F.length(text) - F.length(without)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))


def _hashes(rows: DataFrame) -> DataFrame:
    """Adds to rows with words ``w``: ``h1``, a hash of every word, and ``h2``, one of every word with the next (or the end)."""
    one = rows.withColumn("h1", F.transform("w", lambda x: F.xxhash64(x)))
    return one.withColumn("h2", F.slice(_chain(F.col("h1"), _from(F.col("h1"), 2)), 1, F.greatest(F.size("h1"), F.lit(1))))


def trusted_weights(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_trusted: int = 8_000,
                    smoothing: float = 1.0) -> list[float]:
    """Per bucket the log ratio (to 3 places) of its shares in trusted and in all text; as many numbers at every size.

    Trusted are labelled documents of quality 1 that are not toxic; ``max_trusted`` bounds (in expectation) how many
    are taken, by a hash of doc_id, so their ids can be broadcast. The raw shares count all words of all documents.
    Without any text all weights are zero.
    """
    known = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
             .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
             .where((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select("doc_id"))
    chosen = bounded_sample(known, "doc_id", max_trusted).withColumn("trusted", F.lit(1))
    marked = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left")
              .select(F.coalesce("trusted", F.lit(0)).alias("trusted"), words(F.col("text")).alias("w")))
    # outer, or Spark infers a filter on the list and computes it twice
    grams = (_hashes(marked).select("trusted", F.explode_outer(F.concat("h1", "h2")).alias("h")).where("h IS NOT NULL")
             .select("trusted", F.pmod("h", F.lit(buckets)).cast("int").alias("bucket")))
    counts = grams.groupBy("bucket").agg(F.sum(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    spark = docs.sparkSession
    full = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0)
    rows = sorted(full.collect())
    n_raw, n_target = sum(r["raw"] for r in rows), sum(r["target"] for r in rows)
    if not n_target:
        return [0.0] * buckets
    # raw shares are smoothed evenly, trusted shares towards the raw ones; so text that is alike in both has ratio 0
    raw = [(r["raw"] + smoothing) / (n_raw + smoothing * buckets) for r in rows]
    pull = smoothing * buckets
    return [round(math.log((r["target"] / p + pull) / (n_target + pull)), 3) for r, p in zip(rows, raw)]


def apply_rules(docs: DataFrame, weights: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: struct ``doc``, n_words, counts, base_failed, llr and kept.

    NULL text counts as empty; texts without words fail the base rules and have llr 0. Repeated rows are judged alike.
    """
    buckets = len(weights)
    # a constant of the plan: Spark folds it once, and lambdas look it up by position
    ratio = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    base = _hashes(surface_counts(docs))
    four = base.withColumn("h4", _chain(F.col("h2"), _from(F.col("h2"), 3)))
    five = F.slice(_chain(F.col("h4"), _from(F.col("h1"), 5)), 1, F.greatest(F.size("w") - 4, F.lit(0)))
    base = four.withColumn("n_repeat_words", let(five, _covered).cast("long"))
    total = F.aggregate(F.concat("h1", "h2"), F.lit(0.0), lambda a, x: a + F.get(ratio, F.pmod(x, F.lit(buckets)).cast("int")))
    n = F.size("w").cast("long")
    judged = base.select(
        "doc", n.alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), "n_symbols", "n_dup_lines", "n_repeat_words",
        ((n < 10) | (100 * F.col("n_repeat_words") > 20 * n)).alias("base_failed"),
        F.when(n > 0, F.round(total / (2 * n), 9)).otherwise(0.0).alias("llr"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that pass, with all their columns."""
    return apply_rules(docs, trusted_weights(docs, labels), threshold).where("kept").select("doc.*")
