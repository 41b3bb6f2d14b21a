"""Phrases whose words stand together more often than chance has it.

Counts come from the longest windows alone: the lead columns of a position are
the words after it, null where a piece ends, and Spark's ROLLUP sums the windows
to those of one word less at the end, down to two words.  No length has windows
of its own.

A window matters only as far as each pair of neighbours in it is frequent, since
a phrase is not more frequent than any part of it.  So words are counted first,
then hashes of pairs of frequent words, and windows end before a pair that is
not frequent.  Both tests are bitmaps, which let through too much but never too
little; the counts of what passes are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simquarry.llm.text import UPPER
from simquarry.session import freeze

LONGEST = 5  # words of a phrase
MIN_COUNT = 100
TOP = 2000
COVERED = 100  # percent of a phrase's count at which a longer phrase stands for it
STOPS = ".,;:!?\x0b\x0c\r"  # besides the line feed

SIEVE_MIN, SIEVE_MAX = 1 << 12, 1 << 24  # bits


def pieces(docs: DataFrame) -> DataFrame:
    """lang and words of each piece that has any; texts end a piece at the stops and at line ends."""
    plain = F.translate(F.coalesce("text", F.lit("")), f"{UPPER}\t{STOPS}", UPPER.lower() + " " + "\n" * len(STOPS))
    cut = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(plain, "\n")).alias("piece"))
    return cut.select("lang", F.filter(F.split("piece", " "), lambda w: w != "").alias("words")).where(F.size("words") > 0)


def sieve(hashes: DataFrame) -> Callable[[Column], Column]:
    """Whether a hash may be among the column ``hash`` of ``hashes``, by one bit each.

    The bitmap has about 32 bits for each hash, and ``SIEVE_MAX`` at most (2 MB);
    with so many hashes that it fills up, more passes and nothing is lost.  It is a
    frozen table of one row, read by a subquery: as a literal its text would stand in
    every plan, and the driver keeps several of them.
    """
    n = hashes.count()
    size = min(max(SIEVE_MIN, 1 << (32 * n).bit_length()), SIEVE_MAX) // 64
    word = lambda h: F.shiftrightunsigned(h, 6).bitwiseAND(size - 1).cast("int")
    bit = lambda h: h.bitwiseAND(63).cast("int")
    set_bit = F.expr("shiftleft(1L, cast(hash & 63 as int))")
    blank = hashes.sparkSession.range(size).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("bits"))
    rows = hashes.select(word(F.col("hash")).alias("at"), set_bit.alias("bits")).unionByName(blank).groupBy("at").agg(F.bit_or("bits").alias("bits"))  # a word of the bitmap each
    bitmap = freeze(rows.agg(F.sort_array(F.collect_list(F.struct("at", "bits")))["bits"].alias("bitmap")))
    return lambda h: F.getbit(bitmap.scalar()[word(h)], bit(h)) == 1


def word_counts(cut: DataFrame, min_count: int) -> DataFrame:
    """lang, word and n of words that stand ``min_count`` times in a language, and a row with a null word for each language's total."""
    counted = cut.select("lang", F.explode("words").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    summed = counted.rollup("lang", "word").agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    return summed.where((F.col("level") == 1) | (F.col("level") == 0) & (F.col("n") >= min_count)).select("lang", "word", "n")


def _at(k: int) -> Column:
    """The word ``k`` places after ``i``, null beyond the piece."""
    return F.get("words", F.col("i") + k)


def _hash(k: int) -> Column:
    return F.xxhash64("lang", _at(k))


def _pair(k: int) -> Column:
    return F.xxhash64(_hash(k), _hash(k + 1))


def frequent_pairs(cut: DataFrame, may_word: Callable[[Column], Column], min_count: int) -> DataFrame:
    """``hash`` of neighbours, each of which may be frequent, that stand ``min_count`` times; hashes may meet, which adds to a count."""
    both = cut.select("lang", "words", F.posexplode("words").alias("i", "w")).where(_at(1).isNotNull() & may_word(_hash(0)) & may_word(_hash(1)))
    return both.groupBy(_pair(0).alias("hash")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count).select("hash")


def windows(cut: DataFrame, may_word: Callable[[Column], Column], may_pair: Callable[[Column], Column], longest: int) -> DataFrame:
    """lang and w1 .. w``longest`` from each position whose first pair may be frequent; null from the first pair on that is not."""

    def good(k: int) -> Column:
        return _at(k + 1).isNotNull() & may_word(_hash(k + 1)) & may_pair(_pair(k))

    found = cut.select("lang", "words", F.posexplode("words").alias("i", "w1")).where(_at(1).isNotNull() & may_word(_hash(0)) & good(0))
    columns, goes_on = ["lang", "w1", _at(1).alias("w2")], F.lit(True)
    for k in range(1, longest - 1):
        found = found.withColumn(f"__{k}", goes_on & good(k))  # a column of its own, as each is needed by the next ones too
        goes_on = F.col(f"__{k}")
        columns.append(F.when(goes_on, _at(k + 1)).alias(f"w{k + 2}"))
    return found.select(*columns)


def phrase_counts(found: DataFrame, longest: int, min_count: int) -> DataFrame:
    """lang, words and n of each phrase of two to ``longest`` words that ``found`` has ``min_count`` times or more."""
    names = [f"w{k}" for k in range(1, longest + 1)]
    shorter = "".join(f", {w}" for w in names[2:])
    rolled = found.sparkSession.sql(
        f"select {', '.join(['lang', *names])}, count(*) as n, {longest} - bit_count(grouping_id()) as size from {{found}} group by rollup((lang, w1, w2){shorter}) having n >= {min_count}",
        found=found,
    )
    # A window that ends early has nulls of its own and is no phrase of the sum's length.
    phrase = F.array_compact(F.array(*names))
    return rolled.where(F.col("size") > 1).select("lang", phrase.alias("words"), "n", "size").where(F.size("words") == F.col("size")).drop("size")


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Uses ``text`` and ``lang`` of ``docs`` (null language: ``und``); null and empty
    texts have no words, repeated rows count each time, other columns are not
    looked at.  n is the language's number of words, a, l and r the numbers of
    occurrences of the phrase and of its parts on both sides of its weakest cut,
    score = floor(1000 a n / (l r)).  A phrase inside a longer one with ``covered``
    percent of its occurrences is left out.  Ranks go by score and a, highest
    first, then by phrase.  An empty table has no phrases.
    """
    cut = pieces(docs)
    words = freeze(word_counts(cut, min_count))
    may_word = sieve(words.where("word is not null").select(F.xxhash64("lang", "word").alias("hash")))
    may_pair = sieve(freeze(frequent_pairs(cut, may_word, min_count)))
    phrases = freeze(phrase_counts(windows(cut, may_word, may_pair, longest), longest, min_count))

    joined = lambda part: F.array_join(part, " ")
    counts = phrases.select("lang", joined("words").alias("part"), "n").unionByName(words.where("word is not null").select("lang", F.col("word").alias("part"), "n"))
    totals = words.where("word is null").select(F.col("lang").alias("__lang"), F.col("n").alias("total"))
    cuts = phrases.select("lang", "words", joined("words").alias("phrase"), F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut")).select(
        "lang", "phrase", "a", "cut", joined(F.slice("words", F.lit(1), F.col("cut"))).alias("left"), joined(F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut"))).alias("right")
    )
    lefts, rights = (counts.select(F.col("lang").alias(f"__lang_{x}"), F.col("part").alias(f"__{x}"), F.col("n").alias(x)) for x in "lr")
    scored = (
        cuts.join(lefts, (F.col("lang") == F.col("__lang_l")) & (F.col("left") == F.col("__l")))
        .join(rights, (F.col("lang") == F.col("__lang_r")) & (F.col("right") == F.col("__r")))
        .join(totals, F.col("lang") == F.col("__lang"))
        .withColumn("score", F.expr("(1000 * cast(a as decimal(38, 0)) * total) div (cast(l as decimal(38, 0)) * r)"))
    )
    weakest = scored.groupBy("lang", "phrase").agg(F.min_by(F.struct("a", "l", "r", F.col("total").alias("n"), "score"), F.struct("score", "cut")).alias("x")).select("lang", "phrase", "x.*")

    # The longer phrase needs one word more only: those between are no rarer than it.
    size = F.size("words")
    inside = F.array(joined(F.slice("words", F.lit(1), size - 1)), joined(F.slice("words", F.lit(2), size - 1)))
    longer = phrases.where(size > 2).select(F.col("lang").alias("__lang"), F.explode(inside).alias("__phrase"), "n").groupBy("__lang", "__phrase").agg(F.max("n").alias("most"))
    left = weakest.join(longer, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__phrase")), "left").where(F.col("most").isNull() | (100 * F.col("most") < covered * F.col("a")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", place.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
