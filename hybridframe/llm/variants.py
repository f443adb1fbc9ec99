"""Spelling variants: words one edit apart, found by sorting all rotations of the marked words (a permuterm index)."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from hybridframe.llm.common import documents, lower_ascii, query, stage, text_or_empty

# A word's form is a near word at least this many times as frequent.
RATIO = 10
LEAST_LENGTH, LEAST_COUNT = 7, 2
# One occurrence of a word in this many loses a letter, as the query's definition has it.
SLIP = 31
MARK = "$"
# Rotations of more characters are kept as two hashes, so that a word of n letters takes n small rows and not n * n letters.
LONG = 64
PRIME, BASE, PER_BATCH = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9BF58476D, 1 << 14
LETTERS = "A-Za-zÀ-ÿ"


def counted_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH, slip: int | None = SLIP) -> DataFrame:
    """``word, n``: the runs of letters (A-Z, a-z and U+00C0 to U+00FF) of ``least`` code points or more, A-Z lower-cased, counted over whole texts.

    With ``slip``, an occurrence whose CRC-32 of ``<id>:<word>`` it divides loses one letter, chosen by the same number; what is then too
    short goes. A null id is an empty string there, a null text has no words. Counts are added up within tasks first.
    """
    runs = df.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(text_or_empty(text_col), F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"))
    words = runs.select("id", lower_ascii(F.col("run")).alias("word"))
    if slip is not None:
        mark = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "word").cast("binary"))
        words = words.select("word", mark.alias("mark"), F.char_length("word").alias("length"))
        at = (F.col("mark") % F.col("length")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.col("length")))
        words = words.select(F.when(F.col("mark") % slip == 0, cut).otherwise(F.col("word")).alias("word")).filter(F.char_length("word") >= least)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def _name(word: str | Column) -> Column:
    """A word, or the digest of a long one, to tell words apart in rows of bounded size."""
    word = F.col(word) if isinstance(word, str) else word
    return F.when(F.char_length(word) <= LONG, word).otherwise(F.concat(F.lit("#"), F.sha2(word.cast("binary"), 256)))


def _rotations(words: DataFrame) -> DataFrame:
    """``at key letter name n place leads`` of all rotations of up to ``LONG + 1`` characters.

    ``key`` is what follows position ``at`` in the marked word, the mark and what precedes it: either the whole
    rotation (``letter`` is null) or the rotation that skips the letter at that position. Words that differ there alone
    have one key, and a word that lacks the letter has it as its whole rotation.
    """
    rows = words.filter(F.char_length("word") <= LONG + 1).select("word", "n", F.explode(F.sequence(F.lit(0), F.char_length("word"))).alias("at"))
    head, rest = F.substring("word", F.lit(1), F.col("at")), lambda skip: F.substring("word", F.col("at") + 1 + skip, F.lit(LONG + 1))
    whole = F.struct(F.concat(rest(0), F.lit(MARK), head).alias("key"), F.lit(None).cast("string").alias("letter"))
    cut = F.struct(F.concat(rest(1), F.lit(MARK), head).alias("key"), F.substring("word", F.col("at") + 1, F.lit(1)).alias("letter"))
    both = rows.select("n", "at", F.char_length("word").alias("length"), F.inline(F.array(whole, cut)))
    return both.filter(F.when(F.col("letter").isNull(), F.col("length") <= LONG).otherwise(F.col("at") < F.col("length"))).drop("length")


def _long_rotations(longest: int):
    """The same for longer rotations: the key is a hash of each side of the mark; ``place`` orders the words of one key."""
    names = ["key", "name", "n", "place", "leads", "cut"]

    def rotations(word: str, name: str, n: int) -> Iterator[tuple]:
        heads, power = [0], [1]
        for letter in word:
            heads.append((heads[-1] * BASE + ord(letter) + 1) % PRIME)
            power.append(power[-1] * BASE % PRIME)
        size = len(word)
        tail = lambda start: f"{(heads[size] - heads[start] * power[size - start]) % PRIME:x}"
        after = [size] * (size + 1)
        for i in range(size - 2, -1, -1):
            after[i] = after[i + 1] if word[i] == word[i + 1] else i + 1
        for at in range(size + 1):
            place = -1
            if at < size:
                # after the words with this letter inserted if the run of it is followed by a larger one, else before
                place = 3 * ord(word[at]) + (1 if after[at] < size and word[after[at]] > word[at] else -1)
            yield f"{at}.{size - at}.{heads[at]:x}.{tail(at)}", name, n, place, False, False
            if at < size and size > longest + 1:
                leads = at == 0 or word[at - 1] != word[at]
                yield f"{at}.{size - at - 1}.{heads[at]:x}.{tail(at + 1)}", name, n, 3 * ord(word[at]), leads, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in range(3))))
        rows = (row for word in words for row in rotations(*word))
        while part := list(itertools.islice(rows, PER_BATCH)):
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*part)], names)

    return run


def _scan(members: DataFrame, group: list[str], order: list[Column], who: Column) -> DataFrame:
    """Per member of a group of two or more: ``name near best_n best`` (the most frequent other one).

    All members are near each other, as the key is what they share. A repeated letter may be left out at any of its places, so a word is
    counted against the shorter one at the first place only (``leads``). A group has at most one member for each letter of the
    alphabet and one without; it is sorted once, its first two members are enough for all others, and no pair is emitted.
    """
    sorted_, whole = Window.partitionBy(*group).orderBy(*order), Window.partitionBy(*group)
    ends = sorted_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    one = F.struct(F.col("n").alias("n"), who.alias("who"))
    rows = members.select(
        "name", "cut", "leads",
        F.row_number().over(sorted_).alias("number"), F.first(one).over(ends).alias("first"), F.nth_value(one, 2).over(ends).alias("second"),
        F.count("*").over(whole).alias("all"), F.count_if(F.col("cut")).over(whole).alias("cuts"), F.count_if(F.col("leads")).over(whole).alias("leading"),
    ).filter("all > 1")
    other = F.when(F.col("number") == 1, F.col("second")).otherwise(F.col("first"))
    near = F.when(~F.col("cut"), F.col("leading")).otherwise(F.col("cuts") - 1 + F.when(F.col("leads"), F.col("all") - F.col("cuts")).otherwise(0))
    return rows.select("name", near.alias("near"), other["n"].alias("best_n"), other["who"].alias("best"))


def spelling_groups(words: DataFrame, word_col: str = "word", n_col: str = "n", ratio: int = RATIO) -> DataFrame:
    """``word n n_near form form_n root`` for every distinct word of ``words``.

    Two words are near if one edit (a letter inserted, deleted or replaced) makes one of the other. ``form`` is the near word with the largest
    ``n`` (of equal ones the smallest), if that is at least ``ratio`` times the word's own, else null. ``root`` is where following the
    forms ends. A form is ``ratio`` times as frequent, so a chain has as many steps as the largest ``n`` has digits, and following
    them by doubled steps takes a few joins.

    All rotations of each word with an end mark are sorted; those that agree but for the skipped letter lie side by side, see ``_rotations``.
    Null words are left out, rows that repeat a word are added up. Very long words are handled by hashes (127 bits) of the same rotations.
    An empty table gives an empty result.
    """
    words = words.select(F.col(word_col).cast("string").alias("word"), F.col(n_col).cast("long").alias("n")).filter("word is not null")
    words = stage(words.groupBy("word").agg(F.sum("n").alias("n")))
    # short rotations: the word is made again from its key, so only the key moves
    head, tail = F.right("key", F.col("at")), F.substring("key", F.lit(1), F.char_length("key") - 1 - F.col("at"))
    made = F.when(F.col("at") == 0, F.concat(F.coalesce("letter", F.lit("")), tail)).otherwise(F.concat(head, F.coalesce("letter", F.lit("")), tail))
    leads = F.coalesce((F.col("at") == 0) | (F.col("letter") != F.right("key", F.lit(1))), F.lit(False)) & F.col("letter").isNotNull()
    keyed = _rotations(words).repartition("key", "at").select("key", "at", "n", made.alias("name"), F.col("letter").isNotNull().alias("cut"), leads.alias("leads"))
    short = _scan(keyed, ["key", "at"], [F.col("n").desc(), F.col("name")], F.col("name"))
    short = short.select(_name("name").alias("name"), "near", "best_n", F.col("best").alias("best_word"))
    long_words = words.filter(F.char_length("word") > LONG).select("word", _name("word").alias("name"), "n")
    longer = long_words.mapInArrow(_long_rotations(LONG), "key string, name string, n long, place long, leads boolean, cut boolean")
    long = _scan(longer, ["key"], [F.col("n").desc(), F.col("place")], F.col("name"))
    # only the largest n of a word can be its form; its word is looked up where it is long
    long = long.join(long_words.select(F.col("name").alias("best"), F.col("word").alias("best_word")), "best").select("name", "near", "best_n", "best_word")
    none = words.select(_name("word").alias("name"), F.lit(0).cast("long").alias("near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best_word"))
    near = none.unionByName(short).unionByName(long).groupBy("name").agg(
        F.sum("near").alias("n_near"), F.min(F.when(F.col("best_n").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best_word"))).alias("best")
    )
    best_n = -F.col("best.less")
    fits = F.coalesce(best_n >= F.col("n") * ratio, F.lit(False))
    found = words.withColumn("name", _name("word")).join(near, "name").select(
        "word", "n", "n_near", F.when(fits, F.col("best.best_word")).alias("form"), F.when(fits, best_n).alias("form_n")
    )
    found = stage(found)
    roots = _roots(found.filter("form is not null").select("word", F.col("form").alias("root")))
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def _roots(steps: DataFrame) -> DataFrame:
    """Follow ``word -> root`` to the end; every round doubles the steps."""
    steps = stage(steps)
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(steps.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            return steps


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = counted_words(documents(spark, sf_dir, "doc_id", "text")).filter(F.col("n") >= LEAST_COUNT)
    return spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")
