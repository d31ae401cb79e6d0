"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, mixture.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that
the stage before kept. All but the last return the columns of documents; the
last adds ``copies``, how often the mixture takes a document (never 0). Columns of
any other name are carried along, also such as the operators use themselves; an
input column ``copies`` is replaced by the last stage. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, linededup, minhash, mixing, toxicity
from tallyframe.llm.scratch import Scratch
from tallyframe.llm.words import SPACE_CLASS

#: Digests of repeated texts are sent to all tasks up to this number; beyond, all rows are grouped by theirs.
BROADCAST_TEXTS = 1_000_000


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the rows of docs that are labelled.

    Null and empty texts have the score of a text without words, which is not
    rejected unless the labels say so of such texts; repeated rows share their
    fate. Without labelled rows every score is 0.5, and all rows stay.
    """
    model = toxicity.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(spark, docs, model).where("NOT rejected").select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a document of smaller id holds too; n_chars follows the text.

    Null and empty texts stay as they are. Rows of one id are one holder of a line,
    so that repeated rows keep theirs.
    """
    found = linededup.dedup_lines(spark, docs)
    row = F.when(F.col("n_dropped") == 0, F.col("row")).otherwise(
        F.col("row").withField("text", F.col("text")).withField("n_chars", F.char_length("text").cast("long"))
    )
    return found.select(row.alias("row")).select("row.*")


def _one_of_each_text(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row for each text, that of the smallest id, with ids or without; rows without words stay.

    Copies collapse in each task before they are shuffled.
    """
    digest = F.when(F.col("text").rlike(SPACE_CLASS.replace("[", "[^", 1)), F.sha2("text", 256))
    rows = docs.select(F.struct("*").alias("row"), digest.alias("digest"), F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("*")).alias("place"))
    some = rows.where("digest IS NOT NULL")
    copied = Scratch(spark, "copies").keep(some.groupBy(F.col("digest").alias("copied")).agg(F.count("*").alias("n")).where("n > 1").select("copied"))
    alone = rows.where("digest IS NULL")
    if copied.count() <= BROADCAST_TEXTS:
        met = rows.join(F.broadcast(copied), F.col("digest") == F.col("copied"), "left")
        some, alone = met.where("copied IS NOT NULL"), met.where("copied IS NULL")
    return some.groupBy("digest").agg(F.min_by("row", "place").alias("row")).select("row.*").unionAll(alone.select("row.*"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies (five words, similarity 0.8 or more).

    Of rows with equal texts one stays, also of those without an id or of one id.
    Texts without words (null, empty or blank) are like nothing and all stay.
    """
    # three steps read them
    docs = Scratch(spark, "texts").keep(_one_of_each_text(spark, docs))
    found = minhash.near_duplicates(spark, docs)
    gone = found.where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth are benchmark windows.

    Null and empty texts have no words and stay; every row is judged by itself, so
    repeated rows share their fate. Without benchmark items all stay.
    """
    return decontaminate.decontaminate(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, with how often, as the column copies (one of docs is replaced).

    Documents without words (null and empty texts) are never taken. Rows that
    agree in id, source and size are taken equally often; a null source is one.
    """
    return mixing.mix(spark, docs.drop("copies")).where("copies > 0").select("row.*", "copies")


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixture", mix_sources),
]

#: The classifier and the rounding are not SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs
