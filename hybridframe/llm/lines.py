"""Line deduplication: lines that many documents share go, the rest of each document stays in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridframe.functions.columns import let
from hybridframe.llm.common import documents, join_groups, lower_ascii, query, stage, text_or_empty

# A key has at least this many code points; it goes when at least this many documents hold it.
LEAST_LENGTH, DOCUMENTS = 20, 3
BLANKS = " \t\n\x0b\x0c\r"


def drop_common_lines(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry=(), least: int = LEAST_LENGTH, most: int = DOCUMENTS
) -> DataFrame:
    """``row`` (a struct of the id and of ``carry``), ``kept`` (the remaining text), ``n_lines`` and ``n_dropped`` for every row of ``df``.

    A text is split at every newline. A line's key is the line without white space (ASCII) at both ends, A-Z lower-cased. Keys
    of ``least`` code points or more that ``most`` documents or more hold lose their lines everywhere but in the last of these
    documents, which is the one with the largest id and keeps all of them.

    Lines are exploded to the key's 128-bit hash; a document counts once for a hash, and counts are added up within tasks
    first, so a line that every document has is one row per task. The hashes to drop meet the lines again, those of
    very frequent ones by broadcast (at most 1,000); a document gets back the positions of its dropped lines, and is put
    together from the stretches between them. Only then do texts move, once.

    A null or empty text is one empty line. Every row is a document, also where rows repeat an id; among them one of the last id
    keeps the lines. Null ids are smallest. Texts of any length and any number of lines take time in proportion.
    An empty table gives an empty result.
    """
    text = text_or_empty(text_col)
    rows = df.select(F.struct(F.col(id_col).alias("id"), *carry).alias("row"), F.col(id_col).alias("id"), text.alias("text"))
    rows = stage(
        rows.select(
            "row", "id", "text", F.monotonically_increasing_id().alias("rid"), _keys(F.col("text"), least).alias("keys")
        )
    )
    found = rows.select("rid", "id", F.explode("keys").alias("key")).select("rid", "id", "key.*")
    # the positions of a key in one document are one row
    holders = rows.select("rid", "id", F.explode(F.array_distinct(F.transform("keys", lambda k: F.struct(k["a"].alias("a"), k["b"].alias("b"))))).alias("key"))
    common = holders.select("rid", "id", "key.*").groupBy("a", "b").agg(F.count("*").alias("n"), F.max(F.struct("id", "rid")).alias("last"))
    common = stage(common.filter(F.col("n") >= most).select("a", "b", "n", F.col("last.rid").alias("keeper")))
    total = common.agg(F.sum("n")).first()[0] or 0
    hits = join_groups(found.drop("id"), common, ["a", "b"], "n", total, 40).filter("keeper <> rid")
    drops = hits.groupBy("rid").agg(F.sort_array(F.collect_list("at")).alias("drops"))
    joined = rows.select("row", "rid", "text").join(drops.hint("shuffle_merge"), "rid", "left")
    lines = F.split("text", "\n")
    return joined.select(
        "row",
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(_without(lines, F.col("drops"))).alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
    )


def _keys(text: Column, least: int) -> Column:
    """``array<struct<at, a, b>>``: the lines whose keys are long enough, with the key's two hashes."""
    keyed = F.transform(F.split(lower_ascii(text), "\n"), lambda line, at: F.struct(at.alias("at"), F.btrim(line, F.lit(BLANKS)).alias("key")))
    kept = F.filter(keyed, lambda k: F.char_length(k["key"]) >= least)
    return F.transform(kept, lambda k: F.struct(k["at"].alias("at"), F.xxhash64(k["key"]).alias("a"), F.xxhash64(F.lit(1), k["key"]).alias("b")))


def _without(lines: Column, drops: Column) -> Column:
    """The lines but those at the sorted positions, joined again; every line is copied once."""

    def joined(lines: Column, drops: Column) -> Column:
        def stretch(k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(drops, k - 1) + 1)
            end = F.when(k == F.size(drops), F.size(lines)).otherwise(F.get(drops, k))
            return F.slice(lines, start + 1, end - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), stretch)), "\n")

    return let(lines, lambda ls: let(drops, lambda ds: joined(ls, ds)))


@query(
    "op12_line_dedup",
    r"""
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
    k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
    SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (c.key IS NOT NULL AND k.doc_id <> c.keeper) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.key IS NULL OR k.doc_id = c.keeper), '')) AS kept_sha256
    FROM k LEFT JOIN c ON k.key = c.key GROUP BY k.doc_id""",
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_common_lines(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(F.col("row.id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
