"""The registered queries of the operators for training text, over the whole given tables, and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, imatch, kneser_ney, langid, licenses, linededup, minhash, mixing, pieces, rlz, toxicity, whitening
from .oracles import ORACLES  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, _table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(spark, docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(spark, _table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(spark, _table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.quality(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(spark, _table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz.remove_repeats(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = toxicity.score(spark, docs, toxicity.train(spark, docs, _table(spark, sf_dir, "labels")))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "threshold", "rejected")


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.encode(spark, _table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), pieces.ids_sha256("ids").alias("ids_sha256"),
        F.sha2(pieces.decode(spark, F.col("ids"), model), 256).alias("decoded_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(spark, _table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    of_each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return found.select("row.vec_id", "n", "deviation", "identity_error", of_each).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(_table(spark, sf_dir, "conversations"))
    return conversations.report(spark, rows, copies="copies")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_near_duplicates, op2_decontamination, op3_license_scan, op4_fingerprints, op5_line_dedup,
        op6_language, op7_quality, op8_mixture, op9_substring_dedup, op10_toxicity,
        op11_sentencepiece, op12_whitening, op13_conversations,
    )
}
