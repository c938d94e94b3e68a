"""The corpus operators over the given tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm.decontamination import contaminated
from oreflow.llm.languages import held_out, predicted, train_on
from oreflow.llm.licences import with_licences
from oreflow.llm.merkle import manifest
from oreflow.llm.oracles import ORACLES
from oreflow.llm.packing import packed
from oreflow.llm.personal_data import BASE_KINDS, learned, listed, with_personal_data
from oreflow.llm.preferences import neighbours_as_rejected, preference_rows
from oreflow.llm.quality_forest import judged
from oreflow.llm.repeats import without_repeats
from oreflow.llm.simhash import simhash_components
from oreflow.llm.tokens import counted, vocabulary
from oreflow.llm.vector_codes import compressed
from oreflow.llm.warc import derivatives, responses

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    marked = simhash_components(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return marked.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 200 bytes."""
    left = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate(
        "removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["begin"]
    )
    return left.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    docs = table(spark, sf_dir, "documents")
    return contaminated(docs, table(spark, sf_dir, "benchmark"))


def pieces(packed_docs: DataFrame) -> DataFrame:
    """Packed pieces with a checksum in place of their ids."""
    return packed_docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut into sequences that mix their sources."""
    return pieces(packed(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY)))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = train_on(docs)
    return predicted(model, docs.select("doc_id", held_out("doc_id").alias("held_out"), "text")).drop("text")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counted(docs, vocabulary(VOCABULARY)).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences named in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_licences(docs).withColumn("score", F.round("score", 6)).drop("text", "found")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page's response."""
    return derivatives(responses(table(spark, sf_dir, "pages")))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with its neighbour's last turn."""
    chosen = table(spark, sf_dir, "conversations")
    return preference_rows(chosen, neighbours_as_rejected(chosen))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, and whether rules and forest keep it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = judged(docs, table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *[f"stats.{c}" for c in rules], "base_failed", "kept", "anomaly")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_personal_data(docs, learned(docs)).withColumn("base", F.filter("personal", lambda s: s["base"]))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("personal")).alias("spans")
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof against the root, with some texts' line ends deleted before it is checked."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    found = manifest(docs, fields, presented={"text": text})
    return found.withColumn("proof", F.sha2("proof", 256)).withColumnRenamed("proof", "proof_sha256")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    return compressed(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_decontamination": op2_decontamination,
    "op3_licences": op3_licences,
    "op4_warc": op4_warc,
    "op5_preferences": op5_preferences,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_personal_data": op11_personal_data,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_codes": op13_vector_codes,
}

__all__ = ["ORACLES", "QUERIES"]
