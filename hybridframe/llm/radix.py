"""Exact duplicates by a distributed radix partition, most significant bytes first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from hybridframe.llm.common import documents, join_groups, lower_ascii, query, stage, text_or_empty

# A level looks at the bytes up to its width. Each width is this many times the last one.
FIRST, GROWTH = 32, 16


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """For every row of ``df`` its group of equal texts: ``keep_id group_size kept text_sha256``.

    Texts are equal when identical after lower-casing A-Z. A most-significant-digit radix partition
    finds the groups: all documents are split by their first bytes, the groups of two or more that
    result by the next bytes, and so on, each level looking at more of them. A group is done when
    it is a single document or when its texts have ended; then its members have been compared on
    every byte, and no digest decides (``text_sha256`` is output only). A level counts the rows of
    every (group, next bytes) with a map-side partial aggregation, so that a group of copies
    is one row per task in the shuffle, whatever its size. Only the bytes looked at are shuffled,
    and only documents not told apart yet go on to the next level, which is written to the shared folder.

    Of equal texts the row with the largest id stays (nulls are smallest; of rows that repeat an
    id, any one stays). A null text is an empty one. An empty table gives an empty result. Columns
    named in ``carry`` are returned in a struct ``row``, so their names cannot clash.
    """
    carried = F.struct(*[F.col(c) for c in (carry or [id_col])]).alias("row")
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), carried)

    first = rows.select(_digits(FIRST).alias("digits")).groupBy("digits").agg(F.count("*").alias("n")).filter("n > 1")
    first = stage(first)
    total = first.agg(F.sum("n")).first()[0] or 0
    level = join_groups(rows.withColumn("digits", _digits(FIRST)), first, ["digits"], "n", total, FIRST)
    level = stage(
        level.select(
            "id", "row",
            F.monotonically_increasing_id().alias("rid"),
            F.sha2(_bytes(), 256).alias("sha"),
            F.when(F.col("n").isNotNull(), F.col("text")).alias("text"),
        )
    )
    done = [
        level.filter(F.col("text").isNull()).select(
            "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
        )
    ]
    width = FIRST
    while total:
        width *= GROWTH
        open_rows = level.filter(F.col("text").isNotNull()).select(
            "id", "row", "rid", "sha", "text", _digits(width).alias("digits"), (F.octet_length("text") <= width).alias("ended")
        )
        groups = stage(
            open_rows.groupBy("digits", "ended")
            .agg(F.count("*").alias("n"), F.max(F.struct("id", "rid")).alias("last"))
            .filter("n > 1")
        )
        longest = groups.agg(F.max(F.octet_length("digits"))).first()[0] or 1
        joined = join_groups(open_rows, groups, ["digits", "ended"], "n", total, longest + 64)
        more = F.col("n").isNotNull() & ~F.col("ended")
        level = stage(
            joined.select(
                "id", "row", "rid", "sha",
                F.when(more, F.col("text")).alias("text"),
                F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
                F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
                (F.col("n").isNull() | (F.col("last.rid") == F.col("rid"))).alias("kept"),
            )
        )
        done.append(level.filter(F.col("text").isNull()).select("row", "keep_id", "group_size", "kept", "sha"))
        total = groups.filter(~F.col("ended")).agg(F.sum("n")).first()[0] or 0
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.withColumnRenamed("sha", "text_sha256")


def _bytes():
    return lower_ascii(F.col("text")).cast("binary")


def _digits(width: int):
    """The first ``width`` bytes. No character takes less than one, so no more characters are lower-cased."""
    return F.substring(lower_ascii(F.substring("text", 1, width)).cast("binary"), 1, width)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, unchanged: one for each text, see ``exact_groups``."""
    return exact_groups(df, id_col, text_col, df.columns).filter("kept").select("row.*")


@query(
    "op5_exact_dedup",
    """
    WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(x) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY x)""",
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_groups(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
