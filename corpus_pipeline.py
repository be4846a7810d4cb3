"""From raw documents to training sequences: quality, exact copies, near copies, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table; what it returns is written before the next stage reads
it. All but the last return the columns of ``documents``. Rows with missing values go through all stages: a missing text
counts as empty, which the quality stage scores like any other text and the mixing stage never takes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import exact, minhash, mixing, packing, quality
from tickloom.llm.common import documents
from tickloom.session import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, scores at least 0.5."""
    model = quality.fit(quality.feature_table(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with the same text up to blanks: the one with the smallest id."""
    return exact.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8: the one with the smallest id."""
    return minhash.near_dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in training order, sources at their target weights; ``n_chars`` is that of the copy."""
    return mixing.mix(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all copies, each a sequence of its own, with their token ids."""
    return packing.pack(docs, added=True).select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [("quality", good_quality), ("exact_dedup", without_copies), ("near_dedup", without_near_copies), ("mixing", mixed),
          ("packing", packed)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
