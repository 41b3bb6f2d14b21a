"""Benchmark decontamination by winnowing.

A document and a benchmark item that share ``WINDOW`` words in a row share the
``WINDOW - GRAM + 1`` grams inside them; keeping the least hash of each run of
that many grams therefore keeps one common fingerprint.  Documents with a
common fingerprint are aligned with the item and extended word by word, so
results are exact.  Items shorter than a window are fingerprinted whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.llm.text import let, positions, text_words
from simquarry.session import broadcast_if_small, freeze

WINDOW = 10
GRAM = 7
SIEVE = 1 << 14


def _grams(words: Column, size: int) -> Column:
    """Hashes of ``size`` words in a row, by position."""
    return let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.transform(positions(0, F.size(h) - size + 1), lambda i: F.xxhash64(*(h[i + j] for j in range(size)), F.lit(size))),
    )


def _winnowed(grams: Column, run: int) -> Column:
    """Distinct least hashes of each ``run`` grams in a row."""
    return let(grams, lambda g: F.array_distinct(F.transform(positions(0, F.size(g) - run + 1), lambda i: F.least(*(g[i + j] for j in range(run))))))


def _items(benchmark: DataFrame, window: int) -> DataFrame:
    """One row for each distinct word sequence of the benchmark: its words and the ids of its items."""
    ids = F.array_sort(F.collect_set(F.col("item_id").cast("string")))
    return (
        benchmark.select("item_id", text_words(F.col("text")).alias("words"))
        .where(F.size("words") > 0)
        .groupBy("words")
        .agg(ids.alias("item_ids"))
        .select(
            F.xxhash64("words").alias("item"),
            "words",
            "item_ids",
            F.least(F.size("words"), F.lit(window)).alias("span"),
        )
    )


def _sieve(prints: DataFrame) -> Callable[[Column], Column]:
    """Whether a fingerprint may be among ``prints``, by one bit of ``SIEVE`` x 64.

    The bitmap has one size whatever the benchmark's; where that is large, more
    fingerprints pass and are sorted out by the join that follows.
    """
    place = lambda p: F.pmod(F.shiftrightunsigned(p, 6), F.lit(SIEVE))
    bit = lambda p: F.pmod(p, F.lit(64)).cast("int")
    p = F.col("print")
    rows = prints.groupBy(place(p).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(print, 64) as int))")).alias("bits")).collect()  # SIEVE rows at most
    words = [0] * SIEVE
    for r in rows:
        words[r["at"]] = r["bits"]
    bitmap = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    return lambda x: F.getbit(bitmap[place(x).cast("int")], bit(x)) == 1


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): the words that lie in a window of a benchmark item.

    Returns doc_id, text_hash, n_words, n_hit, item_ids (sorted strings).  Null
    and empty texts have no words and no hits.  Rows with one doc_id but other
    texts are told apart by the hash of their text; repeated rows each get the
    same result.  An item with a null id still marks words, but is not listed.
    An empty benchmark gives no hits.  Other columns are not looked at.
    """
    items = freeze(_items(benchmark, window))
    short = sorted(r["span"] for r in items.where(F.col("span") < window).select("span").distinct().collect())  # window - 1 values at most
    run = window - gram + 1

    def prints(words: Column) -> Column:
        return _winnowed(_grams(words, gram), run)

    def kinds(words: Column) -> Column:
        # (fingerprints of long items, then of each short length that exists)
        return F.array_distinct(F.concat(prints(words), *(_grams(words, k) for k in short))) if short else prints(words)

    item_prints = items.select(
        F.explode(F.when(F.col("span") < window, F.array(F.lit(None).cast("long"))).otherwise(prints(F.col("words")))).alias("print")
    ).where("print is not null")
    for k in short:
        item_prints = item_prints.unionByName(items.where(F.col("span") == k).select(F.explode(_grams(F.col("words"), k)).alias("print")))
    item_prints = freeze(item_prints.distinct())

    # One pass over the texts: a bitmap of fixed size keeps the fingerprints that
    # an item may have, the join with the items' own then decides.
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sieve = _sieve(item_prints)
    seen = freeze(
        keyed.select(
            "doc_id",
            "text_hash",
            let(text_words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.filter(kinds(w), sieve).alias("prints"))).alias("x"),
        ).select("doc_id", "text_hash", "x.*")
    )
    counted = seen.select("doc_id", "text_hash", "n_words")
    found = seen.select("doc_id", "text_hash", F.explode("prints").alias("print")).join(broadcast_if_small(item_prints), "print")
    hits = freeze(found.groupBy("doc_id", "text_hash").agg(F.collect_set("print").alias("prints")))

    # Where the fingerprints stand, in items and in the documents that have one.
    def places(words: Column, wanted: Column) -> Column:
        sizes = [gram, *short]
        return F.flatten(
            F.array(
                *(
                    let(_grams(words, k), lambda g: F.filter(F.transform(g, lambda x, i: F.struct(x.alias("print"), i.alias("at"))), lambda p: F.array_contains(wanted, p["print"])))
                    for k in sizes
                )
            )
        )

    sized = items.select("item", "words", "span", F.explode(F.when(F.col("span") < window, F.array(F.col("span"))).otherwise(F.array(F.lit(gram)))).alias("k"))
    stands = None
    for k in [gram, *short]:
        part = sized.where(F.col("k") == k).select("item", F.posexplode(_grams(F.col("words"), k)).alias("item_at", "print"))
        stands = part if stands is None else stands.unionByName(part)
    stands = freeze(stands.join(F.broadcast(item_prints) if item_prints.count() <= 500_000 else item_prints, "print", "left_semi"))

    touched = (
        keyed.alias("d")
        .join(hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")))
        .select("d.doc_id", "d.text_hash", "d.text", "h.prints")
        .dropDuplicates(["doc_id", "text_hash"])
        .select("doc_id", "text_hash", text_words(F.col("text")).alias("doc_words"), "prints")
    )
    touched = freeze(touched)
    aligned = (
        touched.select("doc_id", "text_hash", F.explode(places(F.col("doc_words"), F.col("prints"))).alias("p"))
        .join(broadcast_if_small(stands), F.col("p.print") == F.col("print"))
        .select("doc_id", "text_hash", "item", (F.col("p.at") - F.col("item_at")).alias("shift"))
        .distinct()
    )
    # The words at the item's place in the document go on, not the whole document.
    placed = (
        aligned.alias("a")
        .join(broadcast_if_small(items), "item")
        .join(touched.alias("t"), F.col("a.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("a.text_hash") == F.col("t.text_hash")))
        .select(
            "a.doc_id", "a.text_hash", "item", "shift", "words", "span", "doc_words",
            F.greatest(F.lit(0), -F.col("shift")).alias("lo"),
            F.least(F.size("words"), F.size("doc_words") - F.col("shift")).alias("hi"),
        )
        .select("doc_id", "text_hash", "item", "shift", "words", "span", "lo", F.slice("doc_words", F.col("lo") + F.col("shift") + 1, F.greatest(F.lit(0), F.col("hi") - F.col("lo"))).alias("part"))
    )
    starts = F.filter(
        positions(0, F.size("part") - F.col("span") + 1),
        lambda s: F.slice("part", s + 1, F.col("span")) == F.slice("words", F.col("lo") + s + 1, F.col("span")),
    )
    matched = (
        placed.select("doc_id", "text_hash", "item", "span", (F.col("lo") + F.col("shift")).alias("base"), starts.alias("starts"))
        .where(F.size("starts") > 0)
        .distinct()
    )
    covered = (
        matched.select("doc_id", "text_hash", F.explode("starts").alias("s"), "base", "span")
        .select("doc_id", "text_hash", F.explode(F.sequence(F.col("base") + F.col("s"), F.col("base") + F.col("s") + F.col("span") - 1)).alias("at"))
        .distinct()
        .groupBy("doc_id", "text_hash")
        .agg(F.count("*").alias("n_hit"))
    )
    named = (
        matched.select("doc_id", "text_hash", "item")
        .distinct()
        .join(broadcast_if_small(items.select("item", "item_ids")), "item")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"))
    )

    def same(a: str, b: str) -> Column:
        return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))

    return (
        counted.alias("d")
        .join(covered.alias("c"), same("d", "c"), "left")
        .join(named.alias("n"), same("d", "n"), "left")
        .select(
            "d.doc_id",
            "d.text_hash",
            "d.n_words",
            F.coalesce("c.n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("n.item_ids", F.array().cast("array<string>")).alias("item_ids"),
        )
    )
