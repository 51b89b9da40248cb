"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.session import scratch_path

from .chat_template import format_conversations, read_back
from .collocations import collocations
from .common import stored, table
from .cotraining import featured, learn_from, scored
from .fingerprint import edit_likeness
from .line_dedup import dedup_lines
from .mixing import mix
from .packing import pack
from .quality_rules import judge
from .simhash import simhash_components
from .token_files import token_digests
from .toxicity import THRESHOLD, held_out, learn, with_score
from .turn_repair import damaged, digests, repair_conversations
from .warc import archived_pages, write_archive

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "quality")


#: The conversation that op3 adds: control strings inside the texts.
PROBE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    written = stored(format_conversations(rows.unionByName(probe)), "chat")
    return read_back(written.repartition("conv_id").sortWithinPartitions("conv_id", "part"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = learn(docs, table(spark, sf_dir, "labels"))
    scored = with_score(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_likeness(table(spark, sf_dir, "documents"))


def op7_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, marks=True).select(
        "doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"))


def op9_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    features = featured(docs, table(spark, sf_dir, "labels"))
    return scored(features, learn_from(features)).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).alias("kept"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    fixed, audits = repair_conversations(damaged(rows))
    out = rows.select("conv_id").distinct()
    for found in (audits, digests(fixed)):
        out = out.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in
              ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm", "warc")
    write_archive(table(spark, sf_dir, "pages"), folder)
    return archived_pages(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_simhash": op1_simhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_chat": op3_chat,
    "op4_toxicity": op4_toxicity,
    "op5_simple8b": op5_simple8b,
    "op6_fingerprints": op6_fingerprints,
    "op7_line_templates": op7_line_templates,
    "op8_mixing": op8_mixing,
    "op9_cotraining": op9_cotraining,
    "op10_packing": op10_packing,
    "op11_repair": op11_repair,
    "op12_warc": op12_warc,
    "op13_collocations": op13_collocations,
}
