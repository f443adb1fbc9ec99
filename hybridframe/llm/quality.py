"""Quality rules whose cutoffs keep false rejections of good documents within a proven limit. Built-in functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hybridframe.llm.common import SPACES, WORD, documents, query, stage

# Good documents of a stratum wrongly rejected by all rules together: at most RISK of them, with confidence 1 - ERROR over all tests.
RISK, ERROR = 0.05, 0.05
# Fixed grids of cutoffs, from mild to strict; a document fails a rule above the cutoff.
RULES = {
    "symbol_share": (0.5, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01),
    "dup_line_share": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05),
    "repeat_share": (0.18, 0.15, 0.12, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01),
    "word_length": (20.0, 15.0, 12.0, 10.0, 9.0, 8.0),
    "word_shortness": (0.7, 0.5, 0.4, 0.35, 0.3, 0.27),
}


def measures(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", carry=()) -> DataFrame:
    """``row id stratum`` and the counts of every text, whole: ``n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words``.

    Windows of five words are compared by their words' chained hash first. Only in texts where two
    hashes are equal are the windows sorted, by hash and words, and positions of equal neighbours collected.
    A null text counts as empty. Rows that repeat an id are measured each; a text's windows are one array, so a text must fit in a task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit(WORD)))
    split = F.filter(F.split(text, SPACES), lambda word: word != "")
    counted = df.select(
        F.struct(F.col(id_col).alias("id"), *carry).alias("row"),
        F.col(id_col).alias("id"),
        F.col(stratum_col).cast("string").alias("stratum"),
        F.col(text_col).alias("text"),
    ).select(
        "row", "id", "stratum",
        split.alias("words"),
        lines.alias("lines"),
        F.char_length(F.regexp_replace(text, SPACES, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    windows = F.when(
        F.size("words") >= 5,
        F.transform(F.sequence(F.lit(1), F.size("words") - 4), lambda i: F.xxhash64(F.slice("words", i, 5))),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.select(
        "row", "id", "stratum", "words", "word_chars", "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("hashes"),
    )
    # twice-or-more hashes by sorting; only then the windows themselves
    suspect = F.size(F.array_distinct("hashes")) < F.size("hashes")
    sorted_windows = F.when(
        suspect,
        F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), F.slice("words", i + 1, 5).alias("w"), i.alias("i")))),
    )
    ordered = hashed.select("*", sorted_windows.alias("places")).drop("hashes")
    same = lambda a, b: (a["h"] == b["h"]) & (a["w"] == b["w"])
    twice = F.filter(
        "places",
        lambda p, k: ((k > 0) & same(p, F.get("places", k - 1))) | ((k < F.size("places") - 1) & same(p, F.get("places", k + 1))),
    )
    found = ordered.select("*", F.array_sort(F.transform(twice, lambda p: p["i"])).alias("at")).drop("places", "words")
    covered = F.aggregate(
        "at",
        F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(i - a["last"], F.lit(5))).alias("n")),
        lambda a: a["n"],
    )
    return found.select(
        "row", "id", "stratum", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")
    )


def values() -> dict[str, Column]:
    """What each rule looks at; a rule rejects what is large."""
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbol_share": F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1)),
        "word_length": mean.cast("double"),
        "word_shortness": 1 / F.greatest(mean, F.lit(0.01)),
    }


def binomial_tail(k: str, n: str, p: float) -> Column:
    """P(X <= k) for n trials of probability p, exactly, by the ratio of neighbouring terms in logarithms."""
    odds = float(p / (1 - p))
    step = lambda a, i: F.struct(
        (a["log"] + F.log((F.col(n) - i + 1) / i * odds)).alias("log"),
        F.when(
            a["log"] + F.log((F.col(n) - i + 1) / i * odds) > a["sum"],
            a["log"] + F.log((F.col(n) - i + 1) / i * odds) + F.log1p(F.exp(a["sum"] - a["log"] - F.log((F.col(n) - i + 1) / i * odds))),
        ).otherwise(a["sum"] + F.log1p(F.exp(a["log"] + F.log((F.col(n) - i + 1) / i * odds) - a["sum"]))).alias("sum"),
    )
    first = F.col(n) * F.log(F.lit(1.0 - p))
    counted = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(F.col(k), F.lit(1))), F.struct(first.alias("log"), first.alias("sum")), step, lambda a: F.exp(a["sum"])
    )
    return F.when(F.col(k) <= 0, F.exp(first)).otherwise(counted)


def _over(name: str, level: Column) -> Column:
    """Whether a document fails a rule at the cutoff of a level."""
    return values()[name] > F.get(F.array(*[F.lit(c) for c in RULES[name]]), level)


def _useful(labelled: DataFrame) -> DataFrame:
    """``stratum`` and for each rule the level of its best cutoff: most bad documents rejected less good ones; null where none does good."""
    good = F.col("quality") == 1
    counts = [
        F.sum(F.when(_over(name, F.lit(level)), F.when(good, -1).otherwise(1)).otherwise(0)).alias(f"{name}_{level}")
        for name, grid in RULES.items() for level in range(len(grid))
    ]
    sums = labelled.groupBy("stratum").agg(*counts)

    def best(name: str) -> Column:
        gains = F.array(*[F.struct(F.col(f"{name}_{level}").alias("gain"), F.lit(-level).alias("mild")) for level in range(len(RULES[name]))])
        top = F.array_max(gains)
        return F.when(top["gain"] > 0, -top["mild"]).alias(name)

    return sums.select("stratum", *[best(name) for name in RULES])


def cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """``stratum rule cutoff`` for every rule that may be used in a stratum.

    ``labelled`` has the measures and ``quality`` (1 good, 0 bad), once for each document, of those that pass the base rules. Half of them, by
    CRC-32 of the id, are the holdout; the other half tells which rules are of use and up to which cutoff. That gives each stratum one
    sequence of sets of rules: at level t every useful rule has its t-th cutoff, or its best one if that is milder, so a set rejects
    all that the one before it does. On the holdout k of n good documents are rejected by a set, by whichever rule; where
    P(X <= k) for n trials at the allowed risk is at most the error, the true rate of the whole set is below the risk. Sets are tested
    from mild to strict until one fails, which costs nothing along the sequence, and the last that holds is taken. The error is shared among the
    strata; a stratum that passes to its end leaves its part to the others (Holm). So with a confidence of 1 - ``error`` no stratum rejects
    more than ``risk`` of its good documents.
    """
    held = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    useful = stage(_useful(labelled.filter(~held)))
    own = useful.select(F.col("stratum").alias("s"), *[F.col(name).alias(f"_{name}") for name in RULES])
    levels = max(len(grid) for grid in RULES.values())
    trials = labelled.filter(held & (F.col("quality") == 1)).join(own, F.col("stratum").eqNullSafe(F.col("s")))
    rejected = lambda level: reduce(lambda a, b: a | b, [F.coalesce(_over(name, F.least(F.lit(level), F.col(f"_{name}"))), F.lit(False)) & F.col(f"_{name}").isNotNull() for name in RULES])
    counts = trials.groupBy("stratum").agg(F.count("*").alias("n"), F.array(*[F.count_if(rejected(level)) for level in range(levels)]).alias("ks"))
    tails = counts.select("stratum", "n", F.posexplode("ks").alias("level", "k")).withColumn("p", binomial_tail("k", "n", risk))
    tails = stage(tails)
    strata, done = tails.select("stratum").distinct().count(), 0
    while True:
        share = error / max(1, strata - done)
        failing = tails.groupBy("stratum").agg(F.min(F.when(F.col("p") > share, F.col("level"))).alias("fails"))
        ended = failing.filter("fails is null").count()
        if ended == done or ended == strata:
            break
        done = ended
    chosen = failing.select(F.col("stratum").alias("s"), (F.coalesce("fails", F.lit(levels)) - 1).alias("level")).filter("level >= 0")
    joined = useful.join(chosen, F.col("stratum").eqNullSafe(F.col("s")))
    rule = lambda name: F.when(
        F.col(name).isNotNull(),
        F.struct(F.lit(name).alias("rule"), F.get(F.array(*[F.lit(c) for c in RULES[name]]), F.least("level", F.col(name))).alias("cutoff")),
    )
    return joined.select("stratum", F.inline(F.array_compact(F.array(*[rule(name) for name in RULES]))))


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", carry=()) -> DataFrame:
    """The measures of every row with ``base_failed`` and ``kept``.

    A stratum without enough labelled documents, null included, gets no cutoffs and keeps all that pass the base rules;
    so do rows when ``labels`` is empty. A document that is labelled twice, or is there twice, counts once, as bad if a label says so; labels
    without a value or an id do not count. A null text is empty and fails the base rules. An empty table gives an empty result.
    """
    measured = stage(measures(df, id_col, text_col, stratum_col, carry))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    measured = measured.withColumn("base_failed", failed)
    known = labels.select(F.col(id_col).alias("id"), "quality").filter("quality is not null and id is not null")
    known = known.groupBy("id").agg(F.min("quality").alias("quality"))
    labelled = measured.drop("row").filter(~F.col("base_failed")).join(known, "id").dropDuplicates(["id"])
    chosen = stage(cutoffs(labelled))
    rules = [F.max(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"_{name}") for name in RULES]
    wide = chosen.groupBy(F.col("stratum").alias("s")).agg(*rules)
    joined = measured.join(wide, measured.stratum.eqNullSafe(F.col("s")), "left")
    rejected = reduce(lambda a, b: a | b, [F.coalesce(value > F.col(f"_{name}"), F.lit(False)) for name, value in values().items()])
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("s", *[f"_{name}" for name in RULES])


@query("op3_quality_rules")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = judge(documents(spark, sf_dir, "doc_id", "text", "lang"), labels)
    return found.select(
        F.col("row.id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
