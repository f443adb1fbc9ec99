"""Mix sources to target weights along a curriculum whose weights change over the training run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hybridframe.llm.common import WORD, documents, query, stage, text_or_empty

# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
# For each of these weights how its demand changes over the run: (time from 0 to 1, relative rate), linear in between.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source source_size tier target`` from the sized documents.

    ``share`` of all words is divided by weight; what exceeds ``most`` times a source's size is
    divided again among the others until none is above. Every round is one aggregate over the sources.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # a source's number is how many sort before it; only the names are sorted, one row each
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    tier = number % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), tier + 1)
    sources = stage(sources.select("source", "source_size", tier.alias("tier"), weight.alias("weight")))
    cap = F.col("source_size") * most
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    rate, capped = 0.0, -1
    while True:
        full = cap <= F.col("weight") * rate if rate else F.lit(False)
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count_if(full)
        ).first()
        if row[2] == capped or not row[1]:
            break
        capped, rate = row[2], (total - row[0]) / row[1]
    return sources.select("source", "source_size", "tier", F.least(cap, F.col("weight") * rate).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry=(), schedules=SCHEDULES) -> DataFrame:
    """The training schedule: a row for each time that a document is taken.

    ``row`` (a struct of the id and the columns in ``carry``), ``size``, ``source``, ``source_size``,
    ``target``, ``taken`` (of the document, over all passes), ``pass`` (0 for the first time), ``words`` (taken this time) and ``position`` (from 0 to 1).

    A source's documents form a stream in the order of the id's MD5, repeated for every pass.
    The source's schedule, integrated over time, is its cumulative demand; inverting it at a
    document's place in the stream gives the time at which it is due. The stream ends with the
    target, where a last document is taken in part. Running sums over a source come from sums
    within range partitions and the partitions' totals, so that no source meets in one task.

    Null and empty texts have size 0 and are taken never; a null source is the last one; a null id
    and repeated rows are documents of their own. Equal positions may come in any order.
    """
    sized = df.select(
        F.struct(F.col(id_col).alias("id"), *carry).alias("row"),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        _size(text_col),
        _key(id_col),
    )
    if not carry:
        turns = _turns(_scheduled(*_placed(sized.drop("row").withColumn("rid", F.lit(None).cast("long"))), schedules))
        return turns.select(F.struct("id").alias("row"), *[c for c in turns.columns if c not in ("id", "rid")])
    # what is carried is written once and meets its turns at the end, so that texts take no part in the sorting
    sized = stage(sized.withColumn("rid", F.monotonically_increasing_id()))
    turns = _turns(_scheduled(*_placed(sized.drop("row")), schedules))
    return sized.select("rid", "row").join(turns.drop("id"), "rid").drop("rid")


def _turns(scheduled: DataFrame) -> DataFrame:
    return scheduled.select("*", F.inline("turns")).drop("turns")


def positions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", schedules=SCHEDULES) -> DataFrame:
    """The schedule with one row per document, sorted by its first training position over range partitions.

    ``id size source source_size target turns taken``; ``turns`` holds the times that the document is taken (``pass words position``), and
    ``taken`` is the sum of their words. Documents that are never taken come first.
    """
    sized = df.select(
        F.col(id_col).alias("id"), F.lit(None).cast("long").alias("rid"), F.col(source_col).alias("source"), _size(text_col), _key(id_col)
    )
    taken = _scheduled(*_placed(sized), schedules).withColumn("turns", F.filter("turns", lambda turn: turn["words"] > 0)).drop("rid")
    return taken.repartitionByRange(_parts(df), F.get("turns", F.lit(0))["position"], "id").sortWithinPartitions(F.get("turns", F.lit(0))["position"], "id")


def _size(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size")


def _key(id_col: str) -> Column:
    return F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key")


def _placed(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with ``before``, the words of the source that precede the row; and the rows as written."""
    ordered = sized.repartitionByRange(_parts(sized), "source", "key", "id").sortWithinPartitions("source", "key", "id")
    place = F.monotonically_increasing_id()
    ordered = stage(ordered.withColumn("place", place).withColumn("part", F.spark_partition_id()))
    # the sorted rows of a partition are cut in chunks, so a window holds a chunk of one source at most
    chunked = ordered.withColumn("chunk", F.shiftright("place", 12))
    sums = stage(chunked.groupBy("source", "part", "chunk").agg(F.sum("size").alias("words")))
    parts = sums.groupBy("source", "part").agg(F.sum("words").alias("words"))
    by_part = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_before", F.coalesce(F.sum("words").over(by_part), F.lit(0))).drop("words")
    by_chunk = Window.partitionBy("source", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("chunk_before", F.coalesce(F.sum("words").over(by_chunk), F.lit(0))).drop("words")
    starts = starts.join(parts, starts.source.eqNullSafe(parts.source) & (starts.part == parts.part)).select(
        starts.source.alias("s"), starts.chunk.alias("c"), (F.col("chunk_before") + F.col("part_before")).alias("start")
    )
    within = Window.partitionBy("chunk", "source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunked.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = placed.join(starts, placed.source.eqNullSafe(starts.s) & (placed.chunk == starts.c))
    return joined.select("id", "rid", "source", "size", (F.col("inside") + F.col("start")).alias("before")), ordered


def _scheduled(placed: DataFrame, sized: DataFrame, schedules) -> DataFrame:
    targets = source_targets(sized)
    joined = placed.join(targets.withColumnRenamed("source", "s"), placed.source.eqNullSafe(F.col("s")))
    words_at = lambda due: F.greatest(F.lit(0), F.least(F.col("size"), F.round("target").cast("long") - due))

    def turn(number: int) -> Column:
        due = F.col("before") + F.col("source_size") * number
        position = F.when(F.col("target") > 0, _time_of(F.least(due / F.col("target"), F.lit(1.0)), schedules))
        return F.struct(F.lit(number).alias("pass"), words_at(due).alias("words"), position.alias("position"))

    turns = joined.withColumn("turns", F.array(*[turn(number) for number in range(int(MOST))]))
    taken = F.aggregate("turns", F.lit(0).cast("long"), lambda sum_, own: sum_ + own["words"])
    return turns.select("id", "rid", "size", "source", "source_size", "target", taken.alias("taken"), "turns")


def _time_of(part: Column, schedules) -> Column:
    """When this part of a source's demand is due, by the inverse of the schedule's integral."""
    tiers = []
    for knots in schedules:
        pieces = [(t0, t1, r0, r1, (r0 + r1) / 2 * (t1 - t0)) for (t0, r0), (t1, r1) in zip(knots, knots[1:])]
        whole, done, found = sum(p[4] for p in pieces), 0.0, F.lit(1.0)
        cases = []
        for t0, t1, r0, r1, area in pieces:
            left, slope = part * whole - done, (r1 - r0) / (t1 - t0)
            done += area
            # left = r0 x + slope x^2 / 2, in the form that holds for a slope of 0 too
            x = 2 * left / (r0 + F.sqrt(F.greatest(F.lit(0.0), r0 * r0 + 2 * slope * left)))
            cases.append((part * whole <= done, t0 + x))
        for test, value in reversed(cases):
            found = F.when(test, value).otherwise(found)
        tiers.append(F.least(found, F.lit(1.0)))
    chosen = tiers[-1]
    for number, value in reversed(list(enumerate(tiers[:-1]))):
        chosen = F.when(F.col("tier") == number, value).otherwise(chosen)
    return chosen


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def curriculum(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``df`` as the mix takes them, sorted by training position over range partitions.

    Texts stay whole: a document is there once for each pass in which it is taken for half of its words or more.
    """
    taken = mix(df, id_col, text_col, source_col, [F.struct(*df.columns).alias("whole")]).filter("words > 0 and 2 * words >= size")
    columns = [F.col("row.whole")[c].alias(c) for c in df.columns]
    return taken.repartitionByRange(_parts(df), "position").sortWithinPartitions("position").select(*columns)


@query(
    "op4_mix_sources",
    """
    WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, sum(size) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS tier FROM d GROUP BY source),
    w AS (SELECT *, CASE tier WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight FROM s),
    r AS (SELECT a.source, 2.0 * a.source_size / a.weight AS ratio,
                 (1.5 * (SELECT sum(source_size) FROM w) - coalesce(sum(2.0 * b.source_size) FILTER (b.source_size / b.weight < a.source_size / a.weight), 0))
                 / sum(b.weight) FILTER (b.source_size / b.weight >= a.source_size / a.weight) AS rate
          FROM w a, w b GROUP BY a.source, a.source_size, a.weight),
    f AS (SELECT arg_min(rate, ratio) FILTER (ratio > rate) AS rate FROM r),
    t AS (SELECT w.source, w.source_size, least(2.0 * w.source_size, coalesce(w.weight * f.rate, 2.0 * w.source_size)) AS target FROM w, f),
    p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d),
    u AS (SELECT p.doc_id, p.size, t.source_size, t.target, w.tier, pass, p.before + pass * t.source_size AS due,
                 greatest(0, least(p.size, CAST(round(t.target) AS BIGINT) - (p.before + pass * t.source_size))) AS words
          FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source JOIN w ON p.source IS NOT DISTINCT FROM w.source, (SELECT unnest([0, 1]) AS pass)),
    v AS (SELECT *, least(CAST(due AS DOUBLE) / target, 1.0::DOUBLE) AS part FROM u),
    x AS (SELECT *, CASE tier WHEN 0 THEN part
                 WHEN 1 THEN CASE WHEN part <= 0.375 THEN 2 * part / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2 * part))
                                  ELSE 0.5::DOUBLE + 2 * (part - 0.375::DOUBLE) / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 2 * (part - 0.375::DOUBLE))) END
                 ELSE 2 * part / (1.5::DOUBLE + sqrt(greatest(0.0::DOUBLE, 2.25::DOUBLE - 2 * part))) END AS position FROM v)
    SELECT doc_id, any_value(size) AS size, CAST(any_value(source_size) AS BIGINT) AS source_size, CAST(any_value(target) AS DOUBLE) AS target,
           CAST(sum(words) AS BIGINT) AS taken, round(max(position) FILTER (pass = 0 AND words > 0), 9) AS first_position,
           round(max(position) FILTER (pass = 1 AND words > 0), 9) AS second_position
    FROM x GROUP BY doc_id""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positions(documents(spark, sf_dir, "doc_id", "text", "source"))
    at = lambda number: F.round(F.get(F.filter("turns", lambda turn: turn["pass"] == number), F.lit(0))["position"], 9)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", at(0).alias("first_position"), at(1).alias("second_position"))
