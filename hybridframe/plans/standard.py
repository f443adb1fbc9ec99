"""The test tables seen as a collection of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def spread(df: DataFrame) -> DataFrame:
    """A table that is read in fewer tasks than there are cores, dealt out to all of them; any other one as it is.

    One Parquet row group is one task, however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels as JSON metadata; an unlabelled document lacks those keys.

    The vector with the same number belongs to a document where there is one.
    """
    documents, labels, vectors = (table(spark, sf_dir, name) for name in ("documents", "labels", "embeddings"))
    return (
        spread(documents).join(labels, "doc_id", "left")
        .join(vectors.select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id", "left")
        .select(
            F.col("doc_id").cast("string").alias("_id"),
            F.col("text").alias("document"),
            "embedding",
            F.to_json(F.struct("lang", "source", "n_chars", "quality", "toxic")).alias("metadata"),
        )
    )


def vector_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors alone, with their class as metadata."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("_id"),
        F.lit(None).cast("string").alias("document"),
        "embedding",
        F.to_json(F.struct("label")).alias("metadata"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their JSON properties inside a nested metadata object."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_id"),
        F.col("event_type").alias("document"),
        F.lit(None).cast("array<float>").alias("embedding"),
        F.concat(F.lit('{"props": '), F.col("props"), F.lit("}")).alias("metadata"),
    )
