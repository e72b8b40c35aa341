"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitaspan.llm import (chat, decontaminate, fill_in_middle, html_text, lm, ordinal, packing, periodic_runs,
                          quality_rules, simhash, token_counts, toxicity, warc)
from vitaspan.llm.common import let, table, words
from vitaspan.llm.registry import query


@query()
def op4_toxicity(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.fit_toxicity(docs, table(spark, folder, "labels")))


@query()
def op10_quality_rules(spark, folder):
    docs = table(spark, folder, "documents")
    weights = quality_rules.trusted_weights(docs, table(spark, folder, "labels"))
    judged = quality_rules.apply_rules(docs, weights)
    return judged.select("doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "llr")


@query()
def op3_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query()
def op2_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


@query()
def op5_token_counts(spark, folder):
    return token_counts.count_sections(table(spark, folder, "documents"))


@query()
def op6_packing(spark, folder):
    return packing.pack(table(spark, folder, "documents"))


@query()
def op7_language_model(spark, folder):
    return lm.score(table(spark, folder, "documents"), order=3)


@query()
def op9_decontamination(spark, folder):
    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op1_chat_format(spark, folder):
    return chat.format_chats(table(spark, folder, "conversations"))


@query()
def op8_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents")
    return ordinal.grade_documents(docs, ordinal.fit_quality(docs, ordinal.grades_of(table(spark, folder, "labels"))))


@query()
def op11_fill_in_middle(spark, folder):
    made = fill_in_middle.transform(table(spark, folder, "documents"))
    text = fill_in_middle.restored(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"))


def _with_loops(doc_id, text):
    """Text in which the last words of every tenth document, by a hash of its id, repeat themselves."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def build(w):
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")).otherwise(F.lit(""))

    return F.when(h % 10 == 0, let(words(text), build)).otherwise(text)


@query()
def op12_periodic_runs(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", _with_loops(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.detect(docs).withColumn("best", periodic_runs.strongest(F.col("runs")))
    best = [F.col(f"best.{x}").alias(x) for x in ("start", "length", "period")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best,
                        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(periodic_runs.listed(F.col("runs")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query()
def op13_warc(spark, folder):
    return warc.archive_pages(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", warc.urn_page(F.col("refers_to")).alias("refers_to"), "url")
