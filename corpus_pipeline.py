"""From documents to packed training sequences, stage by stage.

Each stage takes all rows that the stage before kept, and its result is written as
Parquet and read again. All stages but the last return the columns of ``documents``.
A null text goes in stage language, as does one without a letter; rows that repeat an id
are handled as the stages' operators say; an empty table gives no rows; further columns
are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import jaccard, langid, lines, packing, pii
from tickloom.llm.queries import PII_KEY, table, tokenizer_files
from tickloom.sources.tables import staged

#: A document stays if its language is likelier than by chance by this part of what is left to
#: certainty, so the limit follows the number of languages; those without a letter go.
MARGIN = 0.1
#: Bytes of an Arrow batch between the JVM and Python. Texts are long: the default of 10,000 rows
#: makes batches that several copies of fill an executor's memory.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 512 << 10


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. If nothing could be learned, all stay."""
    net = langid.train(docs)
    if not net.languages:
        return docs
    judged = langid.identify(docs, net)
    chance = 1 / len(net.languages)
    sure = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= chance + MARGIN * (1 - chance))
    return judged.where(sure).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the runs of lines that an earlier one holds; those of which nothing is left go."""
    left = lines.dedup_lines(docs, removed_col="_removed")
    return _counted(left.where(~((F.col("_removed") > 0) & (F.col("text") == ""))).select(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return jaccard.first_of_each(docs, words=5, num=80, den=100)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return _counted(pii.pseudonymise(docs, PII_KEY, spans_col=None))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, in sequences."""
    return packing.pack(docs, tokenizer_files())


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _in_small_batches(stage):
    """The stage, in a session that hands texts to Python in small batches unless it was given a size."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.sparkContext.getConf().get(BATCH) is None:
            spark.conf.set(BATCH, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    (name, _in_small_batches(stage))
    for name, stage in (
        ("language", language),
        ("line_dedup", line_dedup),
        ("near_duplicates", near_duplicates),
        ("private_data", private_data),
        ("packing", pack),
    )
]

#: The stages that learn, hash or tokenize have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
