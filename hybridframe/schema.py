"""The record: one id, one text, one vector and one JSON object per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

ID = "_id"
DOCUMENT = "document"
EMBEDDING = "embedding"
METADATA = "metadata"

RECORD = T.StructType(
    [
        T.StructField(ID, T.StringType(), False),
        T.StructField(DOCUMENT, T.StringType()),
        T.StructField(EMBEDDING, T.ArrayType(T.FloatType())),
        T.StructField(METADATA, T.StringType()),
    ]
)
FIELDS = RECORD.fieldNames()

# Fixed values of the collection contract.
MAX_ID_BYTES = 512
DEFAULT_DIMENSION = 384
METRICS = ("l2", "cosine", "inner_product")

# Plural names are the public ones; the singular column names are accepted as well.
INCLUDE = {
    "documents": DOCUMENT,
    "document": DOCUMENT,
    "metadatas": METADATA,
    "metadata": METADATA,
    "embeddings": EMBEDDING,
    "embedding": EMBEDDING,
}
DEFAULT_INCLUDE = ("documents", "metadatas")


def included(include=None) -> list[str]:
    """Record columns that an include list asks for. Unknown names ask for nothing."""
    names = DEFAULT_INCLUDE if include is None else include
    asked = {INCLUDE[name] for name in names if name in INCLUDE}
    return [field for field in FIELDS if field in asked]


def conform(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Give any frame with an ``_id`` the four record columns, nulls where it has none."""
    def pick(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[pick(field) for field in RECORD.fields], *keep)


def fault(dimension: int) -> Column:
    """Why a record cannot be stored, or NULL when it can."""
    return (
        F.when(F.col(ID).isNull() | (F.col(ID) == ""), F.lit("empty id"))
        .when(F.octet_length(ID) > MAX_ID_BYTES, F.lit("id too long"))
        .when(F.size(EMBEDDING) != dimension, F.lit("wrong vector size"))
        .when(F.exists(EMBEDDING, lambda x: x.isNull() | F.isnan(x)), F.lit("vector holds no number"))
        .when(
            F.col(METADATA).isNotNull()
            & ~F.coalesce(F.schema_of_variant(F.try_parse_json(METADATA)).startswith("OBJECT"), F.lit(False)),
            F.lit("metadata is not a JSON object"),
        )
    )


def split_rejects(df: DataFrame, dimension: int) -> tuple[DataFrame, DataFrame]:
    """Storable records, and the others with a ``reason``; one bad row does not fail a load."""
    judged = df.withColumn("reason", fault(dimension))
    return judged.filter("reason is null").drop("reason"), judged.filter("reason is not null")
