"""Quality rules as a ledger of failure bits.

Every rule is evaluated once a document.  The ledger keeps what was measured
and one bit for each rule that failed; policies are masks over these bits with
a version, so a new policy, or the effect of leaving a rule out, needs no text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.llm.text import BLANK_WORD, blank_words, let, positions

SYMBOLS = "#*$%&|<>"

# Rules in the order of their bits.
RULES = ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words")


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject a document."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES.index(r) for r in self.rules)


BASE = Policy(1, ("few_words", "repeated_words"))
FULL = Policy(2, RULES)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of three words that occur twice or more.

    Windows are hashed and sorted with their positions; a window is repeated if
    a neighbour in that order has its hash.  Sorted again by position, each
    start covers three words, or as many as there are before the next start.
    """
    n = F.size(words)
    grams = F.transform(positions(0, n - 2), lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")))

    def starts(s: Column) -> Column:
        last = F.size(s) - 1
        hit = F.filter(s, lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == x["h"])) | ((k < last) & (s[F.least(k + 1, last)]["h"] == x["h"])))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def covered(d: Column) -> Column:
        steps = F.transform(d, lambda x, k: F.when(k == F.size(d) - 1, 3).otherwise(F.least(F.lit(3), d[F.least(k + 1, F.size(d) - 1)] - x)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(F.sort_array(grams), starts), covered)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``quality``: measurements and ``failed``, the bits of the rules that failed.

    Null and empty texts measure zero everywhere and fail ``few_words``.
    Columns of ``docs`` stay as they are, except one already named ``quality``.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(BLANK_WORD))
    n_lines = F.size(lines)

    def of(words: Column) -> Column:
        n = F.size(words).cast("long")
        return F.struct(
            n.alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.char_length(w)).alias("word_chars"),
            (F.char_length(body) - F.char_length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            n_lines.cast("long").alias("n_lines"),
            (n_lines - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).alias("n_repeat_words"),
        )

    def bits(m: Column) -> Column:
        fails = {
            "few_words": m["n_words"] < 50,
            "repeated_words": 100 * m["n_repeat_words"] > 50 * m["n_words"],
            "symbols": 100 * m["n_symbols"] > 10 * m["word_chars"],
            "repeated_lines": 100 * m["n_dup_lines"] > 60 * m["n_lines"],
            "short_words": m["word_chars"] < 2 * m["n_words"],
            "long_words": m["word_chars"] > 20 * m["n_words"],
        }
        total = F.lit(0).cast("long")
        for k, rule in enumerate(RULES):
            total = total.bitwiseOR(F.when(fails[rule], F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        return F.struct(*(m[x].alias(x) for x in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")), total.alias("failed"))

    return docs.withColumn("quality", let(let(blank_words(F.col(text)), of), bits))


def fails(policy: Policy, failed: Column) -> Column:
    """Whether ``policy`` rejects a document with these bits."""
    return failed.bitwiseAND(F.lit(policy.mask)) != 0


def ablations(ledger: DataFrame, policy: Policy, failed: str = "quality.failed") -> DataFrame:
    """For each rule of ``policy``: documents that fail it, that only it rejects, and that stay if it is left out.

    One aggregate over the distinct bit patterns (at most 2 to the number of
    rules), so the texts are not read again.
    """
    patterns = ledger.groupBy(F.col(failed).alias("bits")).count()
    one = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES.index(r)).cast("long").alias("bit")) for r in policy.rules))).alias("r")
    hit = F.col("bits").bitwiseAND(F.lit(policy.mask))
    n = lambda cond: F.sum(F.when(cond, F.col("count")).otherwise(0))
    return (
        patterns.select("bits", "count", one)
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            n(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
            n(hit == F.col("r.bit")).alias("n_only"),
            n((hit == 0) | (hit == F.col("r.bit"))).alias("n_kept_without"),
        )
        .withColumn("version", F.lit(policy.version))
    )
