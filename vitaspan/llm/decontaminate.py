"""Benchmark decontamination by spaced seeds, with DataFrame functions only.

Fixed masks over a few words ignore the words in between, so a hash still meets its partner when an ignored word was
replaced. Hashes of the benchmark's windows are joined with those of all documents' windows; around each hit the two
texts are laid side by side and the best stretch is scored, a word that agrees +1 and one that differs -1. Items of
fewer words than a mask are found where all their words follow each other in a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitaspan.llm.common import let, words

#: Words that count (1) and words that are ignored (0). Each is made of three pairs of neighbours.
MASKS = ("11011011", "110011011", "110110011")
#: Signs that part words like white space does.
PUNCTUATION = ".,;:!?\"'()"
#: Least score of a stretch; items of fewer than MIN_SCORE / MIN_SHARE words need this share of their words, which is
#: four matches to one difference over the whole item.
MIN_SCORE = 12
MIN_SHARE = 0.6
#: Bits of the table that passes over document windows without a partner; every hit is joined exactly after it.
FILTER_BITS = 1 << 22
#: Benchmark windows up to this number are broadcast (24 bytes each); beyond, both sides are shuffled.
BROADCAST_WINDOWS = 500_000


def tokens(text: Column) -> Column:
    """Lower-cased words between white space and common punctuation; NULL: none."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    for mark in PUNCTUATION:
        plain = F.replace(plain, F.lit(mark), F.lit(" "))
    return words(plain)


def _starts(mask: str) -> list[int]:
    """Positions of the pairs in a mask."""
    found, i = [], 0
    while (i := mask.find("11", i)) >= 0:
        found.append(i)
        i += 2
    return found


def _windows(rows: DataFrame) -> DataFrame:
    """Rows with word hashes ``h`` get ``n`` and ``masked``: the hashes of all windows, mask after mask."""
    at = lambda a, k: F.slice(a, k + 1, F.greatest(F.size(a), F.lit(1)))
    chain = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    rows = rows.withColumn("n", F.size("h")).withColumn("pairs", chain(F.col("h"), at(F.col("h"), 1)))
    heads: dict[int, str] = {}
    for mask in MASKS:
        _, second, _ = _starts(mask)
        if second not in heads:
            heads[second] = f"head{second}"
            rows = rows.withColumn(heads[second], chain(F.col("pairs"), at(F.col("pairs"), second)))
    parts = []
    for mask in MASKS:
        _, second, third = _starts(mask)
        whole = chain(F.col(heads[second]), at(F.col("pairs"), third))
        parts.append(F.slice(whole, 1, F.greatest(F.col("n") - len(mask) + 1, F.lit(0))))
    return rows.withColumn("masked", F.concat(*parts)).drop("pairs", *heads.values())


def _exploded(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per window: ``keep``, its hash ``seed`` and the position ``at`` of its first word."""
    # outer, or Spark infers a filter on the list and computes it twice
    out = _windows(rows).select(*keep, "n", F.posexplode_outer("masked").alias("at", "seed")).where("seed IS NOT NULL")
    first = F.greatest(F.col("n") - len(MASKS[0]) + 1, F.lit(0))
    rest = F.col("n") - len(MASKS[1]) + 1
    return out.select(*keep, "n", "seed", F.when(F.col("at") < first, F.col("at"))
                      .otherwise((F.col("at") - first) % F.greatest(rest, F.lit(1))).alias("at"))


def _word_hashes() -> Column:
    return F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w))


def _hashed(table: DataFrame, key: str) -> DataFrame:
    return table.where(F.col(key).isNotNull()).select(key, _word_hashes().alias("h"))


def _sequences(rows: DataFrame, lengths: list[int], listed) -> DataFrame:
    """doc_id, n, seed and at of all runs of ``lengths`` words whose hash is ``listed``; rows have word hashes ``h``."""
    rows = rows.withColumn("s1", F.col("h"))
    for n in range(2, max(lengths) + 1):
        rows = rows.withColumn(f"s{n}", F.zip_with(f"s{n - 1}", F.slice("h", n, F.greatest(F.size("h"), F.lit(1))), lambda x, y: F.xxhash64(x, y)))

    def found(n: int) -> Column:
        whole = F.slice(f"s{n}", 1, F.greatest(F.size("h") - n + 1, F.lit(0)))
        at = F.transform(whole, lambda x, i: F.when(listed(x), F.struct(F.lit(n).alias("n"), x.alias("seed"), i.alias("at"))))
        return F.filter(at, lambda x: x.isNotNull())

    # outer, or Spark infers a filter on the list and computes it twice
    return rows.select("doc_id", F.explode_outer(F.concat(*[found(n) for n in lengths])).alias("f")).where("f IS NOT NULL").select("doc_id", "f.*")


def overlaps(docs: DataFrame, benchmark: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """One row per document and item that overlap: doc_id, item_id, score, n_matched, n_differing, doc_word, item_word.

    The stretch with the highest score counts; side by side the one that ends first and then the shortest, of several
    places the earliest in the document. doc_word and item_word are where it begins. An item reaches a document only
    through a hit; items of fewer words than a mask are reported where the document has all their words in a row. Rows
    without an id and NULL or empty texts give nothing; rows that repeat an id count together; other columns are ignored.
    """
    every = _hashed(benchmark, "item_id").where(F.size("h") > 0).distinct()
    items = every.where(F.size("h") >= len(MASKS[0]))
    short = every.where(F.size("h") < len(MASKS[0])).select("item_id", F.size("h").alias("n"), F.aggregate(
        F.slice("h", 2, len(MASKS[0])), F.get("h", F.lit(0)), lambda a, x: F.xxhash64(a, x)).alias("seed")).distinct()
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())
    seeds = _exploded(items, "item_id").select("item_id", F.col("n").alias("n_item"), "seed", F.col("at").alias("item_at")).distinct()
    place = F.pmod("seed", F.lit(FILTER_BITS))
    bits = (seeds.select("seed").unionAll(short.select("seed")).select((place / 64).cast("int").alias("i"), F.expr(f"shiftleft(1L, int(pmod(seed, {FILTER_BITS}) % 64))").alias("bit"))
            .groupBy("i").agg(F.bit_or("bit").alias("bits"), F.count("*").alias("n")).collect())
    table_bits = [0] * (FILTER_BITS // 64)
    for r in bits:
        table_bits[r["i"]] = r["bits"]
    small = sum(r["n"] for r in bits) <= BROADCAST_WINDOWS
    partner = (lambda d: F.broadcast(d)) if small else (lambda d: d)
    # a constant of the plan, of one size whatever the benchmark's; it only spares the join windows without a partner
    table = F.split(F.lit(",".join(map(str, table_bits))), ",").cast("array<bigint>")
    listed = lambda x: F.getbit(F.get(table, (F.pmod(x, F.lit(FILTER_BITS)) / 64).cast("int")),
                                (F.pmod(x, F.lit(FILTER_BITS)) % 64).cast("int")) == 1

    hashed = _hashed(docs, "doc_id")
    kept = _exploded(hashed, "doc_id").where(listed(F.col("seed")))
    hits = (kept.select("doc_id", "seed", F.col("at").alias("doc_at")).join(partner(seeds), "seed")
            .select("doc_id", "item_id", "n_item", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct())
    by_doc = hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "n_item", "shift")).alias("hits"))
    # the texts of documents with hits are hashed again: hashes of all words would not compress in a shuffle
    texts = docs.select("doc_id", "text").join(by_doc, "doc_id").select("doc_id", "hits", _word_hashes().alias("h"))
    side = texts.select("doc_id", F.explode(F.transform("hits", lambda c: F.struct(
        c["item_id"].alias("item_id"), c["shift"].alias("shift"),
        F.slice("h", F.greatest(c["shift"], F.lit(0)) + 1, c["n_item"] + F.least(c["shift"], F.lit(0))).alias("d")))).alias("c"))
    laid = side.select("doc_id", "c.*").join(partner(items), "item_id")
    scored = laid.select("doc_id", "item_id", "shift", F.size("h").alias("n_item"), _best(
        F.zip_with("d", F.slice("h", 1 - F.least("shift", F.lit(0)), F.greatest(F.size("d"), F.lit(1))),
                   lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)))).alias("s"))
    enough = F.least(F.lit(float(min_score)), MIN_SHARE * F.col("n_item"))
    good = scored.where(F.col("s.score") >= enough).select(
        "doc_id", "item_id", "s.score", F.col("s.matched").alias("n_matched"), (F.col("s.matched") - F.col("s.score")).alias("n_differing"),
        (F.col("s.start") + F.greatest("shift", F.lit(0))).alias("doc_word"),
        (F.col("s.start") - F.least("shift", F.lit(0))).alias("item_word"))
    best = good.groupBy("doc_id", "item_id").agg(F.min(F.struct(
        (-F.col("score")).alias("minus"), "doc_word", "item_word", "n_matched", "n_differing")).alias("b"))
    found = best.select("doc_id", "item_id", (-F.col("b.minus")).alias("score"), "b.n_matched", "b.n_differing", "b.doc_word", "b.item_word")
    if not lengths:
        return found
    # one row per document and run of words before the join, however often the document repeats it
    runs = _sequences(hashed, lengths, listed).groupBy("doc_id", "n", "seed").agg(F.min("at").alias("at"))
    whole = runs.join(partner(short), ["n", "seed"]).groupBy("doc_id", "item_id", "n").agg(F.min("at").alias("at"))
    longest = whole.groupBy("doc_id", "item_id").agg(F.min(F.struct((-F.col("n")).alias("minus"), "at")).alias("b"))
    exact = longest.select("doc_id", "item_id", (-F.col("b.minus")).alias("score"), (-F.col("b.minus")).alias("n_matched"),
                           F.lit(0).alias("n_differing"), F.col("b.at").alias("doc_word"), F.lit(0).alias("item_word"))
    if every.groupBy("item_id").agg(F.min(F.size("h")).alias("a"), F.max(F.size("h")).alias("b")).where(
            (F.col("a") < len(MASKS[0])) & (F.col("b") >= len(MASKS[0]))).limit(1).collect():
        # an id with a short and a long text: still one row
        both = found.unionByName(exact).groupBy("doc_id", "item_id").agg(F.max_by(F.struct(
            "score", "n_matched", "n_differing", "doc_word", "item_word"), F.struct("score", -F.col("doc_word"), -F.col("item_word"))).alias("b"))
        return both.select("doc_id", "item_id", "b.*")
    return found.unionByName(exact)


def _best(agree: Column) -> Column:
    """score, matched and start of the best stretch of an array of 0 and 1; the first of equals."""
    state = lambda run, start, matched, score, best_start, best_matched, at: F.struct(
        run.alias("run"), start.alias("start"), matched.alias("matched"), score.alias("score"),
        best_start.alias("best_start"), best_matched.alias("best_matched"), at.alias("at"))
    zero = F.lit(0)

    def step(s: Column, x: Column) -> Column:
        fresh = s["run"] <= 0
        run = F.when(fresh, 0).otherwise(s["run"]) + 2 * x - 1
        start = F.when(fresh, s["at"]).otherwise(s["start"])
        matched = F.when(fresh, 0).otherwise(s["matched"]) + x
        better = run > s["score"]
        return state(run, start, matched, F.greatest(run, s["score"]), F.when(better, start).otherwise(s["best_start"]),
                     F.when(better, matched).otherwise(s["best_matched"]), s["at"] + 1)

    found = F.aggregate(agree, state(zero, zero, zero, zero, zero, zero, zero), step)
    return let(found, lambda s: F.struct(s["score"].alias("score"), s["best_matched"].alias("matched"), s["best_start"].alias("start")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: int = MIN_SCORE) -> DataFrame:
    """Documents that overlap with no item, with all columns. Each row is judged by its text, whatever its doc_id."""
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))
    own = docs.withColumn("__text", key)
    found = overlaps(own.select(F.col("__text").alias("doc_id"), "text"), benchmark, min_score).select(F.col("doc_id").alias("__found")).distinct()
    return own.join(found, F.col("__text") == F.col("__found"), "left_anti").drop("__text")
