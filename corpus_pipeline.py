"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a
DataFrame; the result is written as Parquet into the shared folder and read again as the
next stage's documents.  All but the last return the columns of ``documents``, in order, and
any further columns the input has.  Rows with a null id pass every stage that decides by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipcatalog.llm import minmax_dedup, packing_plan, secrets, tiling_decontam, toxic_neighbours
from clipcatalog.llm.common import settled, table

#: near-duplicates share 80 of 100 word shingles; at 0.80, 36 bands of 5 miss a pair with probability 6e-7
NEAR_PERCENT, NEAR_BANDS = 80, 36

#: no SQL: the classifier, the linked groups and the tokenizer cannot be expressed in it
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; null and empty texts stay unless the model rejects them."""
    model = toxic_neighbours.fitted(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxic_neighbours.scorer(spark, model)(F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    gone = minmax_dedup.near_duplicates(docs, percent=NEAR_PERCENT, n_bands=NEAR_BANDS).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more go."""
    found = tiling_decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked and ``n_chars`` follows."""
    masked = secrets.mask_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return masked


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in the packed sequences."""
    return packing_plan.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
