"""Removal of passages of whole lines that repeat across the corpus.

A run of lines of more than fifty words that stands in an earlier text too, or
earlier in the same text, is removed whole.  Any such run is covered by its
windows: the shortest of so many words from each of its lines on, and the
shortest that end with each of its lines.  They depend on their own lines only, so
a passage has the same windows wherever it stands.

Shorter passages are found where a rolling hash over the last lines says so: a
text is cut there into chunks, and chunks of two lines or more count as well.
Windows and chunks that occur elsewhere too are removed but for their first
occurrence, after the bytes of their lines have been compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.llm.text import BLANK_WORD, let, positions
from simquarry.session import BROADCAST_ROWS, broadcast_if_small, freeze

LINES = 2  # lines under the rolling hash
EVERY = 3  # one line in so many ends a chunk
MIN_WORDS = 20  # shorter chunks are boilerplate of layout and stay
LONG = 51  # words of a passage that is found wherever it stands; a line of so many is a chunk of its own


def _n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(BLANK_WORD))


def _chunks(text: Column, lines: int, every: int, long: int) -> Column:
    """Chunks of a text in order: their number, first line, number of lines and text.

    A line ends a chunk if the hash over it and the ``lines - 1`` before it is
    divisible by ``every``; the first lines of a text use those that exist.  A
    line of ``long`` words or more starts and ends a chunk.
    """

    def cut(ls: Column) -> Column:
        n = F.size(ls)
        # So many words need as many characters, and blanks between them.
        is_long = lambda x: (F.char_length(x) >= 2 * long - 1) & (_n_words(x) >= long)
        seen = F.transform(ls, lambda x: F.struct(F.xxhash64(x).alias("hash"), is_long(x).alias("long")))

        def ends(s: Column) -> Column:
            roll = lambda i: F.xxhash64(F.slice(s["hash"], F.greatest(F.lit(1), i - lines + 2), F.least(F.lit(lines), i + 1)))
            apart = lambda i: s[i]["long"] | s[F.least(i + 1, n - 1)]["long"]
            return F.filter(positions(0, n), lambda i: (i == n - 1) | apart(i) | (F.pmod(roll(i), F.lit(every)) == 0))

        def parts(e: Column) -> Column:
            first = lambda k: F.when(k == 0, 0).otherwise(e[F.greatest(k - 1, F.lit(0))] + 1)
            return F.transform(
                e,
                lambda end, k: F.struct(k.alias("chunk"), first(k).alias("line"), (end - first(k) + 1).alias("n_lines"), F.array_join(F.slice(ls, first(k) + 1, end - first(k) + 1), "\n").alias("text")),
            )

        return let(let(seen, ends), parts)

    return let(F.split(text, "\n", -1), cut)


def _spans(text: Column, lines: int, every: int, min_words: int, long: int) -> Column:
    """line, n_lines, h1 and h2 of the windows of ``long`` words and of the chunks of ``min_words`` words and two lines.

    A window from a line on is the shortest that has ``long`` words, and so is one
    that ends with a line.
    """
    seen = F.transform(F.split(text, "\n", -1), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), _n_words(x).alias("words")))

    def spans(s: Column) -> Column:
        n = F.size(s)
        # Words up to the end of each line: sums over 1, 2, 4, ... lines before.
        step = lambda k: F.call_function("shiftleft", F.lit(1), k)
        sums = F.aggregate(F.sequence(F.lit(0), F.length(F.bin(n))), s["words"], lambda a, k: F.transform(a, lambda x, i: x + F.when(i >= step(k), a[i - step(k)]).otherwise(0)))
        # The line of each word.
        line_of = F.flatten(F.transform(s, lambda x, i: F.array_repeat(i, x["words"])))

        def windows(upto: Column, at: Column) -> Column:
            before = lambda i: upto[i] - s[i]["words"]
            stop = lambda i: at[before(i) + long - 1]
            start = lambda j: at[upto[j] - long]
            span = lambda first, last: F.struct(first.alias("line"), (last - first + 1).alias("n_lines"))
            onward = F.transform(F.filter(positions(0, n), lambda i: upto[n - 1] - before(i) >= long), lambda i: span(i, stop(i)))
            back = F.transform(F.filter(positions(0, n), lambda j: F.when(upto[j] >= long, stop(start(j)) < j).otherwise(False)), lambda j: span(start(j), j))
            chunks = F.filter(_chunks(text, lines, every, long), lambda c: (c["n_lines"] >= 2) & (upto[c["line"] + c["n_lines"] - 1] - before(c["line"]) >= min_words))
            of = lambda w: F.slice(s, w["line"] + 1, w["n_lines"])
            return F.transform(
                F.concat(onward, back, F.transform(chunks, lambda c: F.struct(c["line"].alias("line"), c["n_lines"].alias("n_lines")))),
                lambda w: F.struct(w["line"].alias("line"), w["n_lines"].alias("n_lines"), F.xxhash64(of(w)["h1"]).alias("h1"), F.xxhash64(F.lit(1), of(w)["h2"]).alias("h2")),
            )

        return let(sums, lambda u: let(line_of, lambda a: windows(u, a)))

    return let(seen, spans)


def repeated_lines(docs: DataFrame, lines: int = LINES, every: int = EVERY, min_words: int = MIN_WORDS, long: int = LONG) -> DataFrame:
    """Lines of passages that occur earlier too: doc_id, text_hash, line, n_chars, first_doc_id.

    Earlier means by (doc_id, text_hash, line), null ids first, and in the same
    text without overlap.  Of rows that are equal in id and text, the passages are
    one occurrence.
    """
    texts = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spans = freeze(texts.select("doc_id", "text_hash", F.explode(_spans(F.col("text"), lines, every, min_words, long)).alias("s")).select("doc_id", "text_hash", "s.*"))
    place = F.struct(F.col("doc_id"), F.col("text_hash"), F.col("line"))
    # First and last place of a hash: a span that occurs once has one place only.
    often = freeze(
        spans.groupBy("h1", "h2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first <> last or (first is null) <> (last is null)")
        .select("h1", "h2", "first")
    )
    other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))
    source = F.struct(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"), (F.col("first.line") + F.col("k")).alias("line"))
    gone = freeze(
        spans.join(broadcast_if_small(often), ["h1", "h2"])
        .where(other | (F.col("first.line") + F.col("n_lines") <= F.col("line")))
        .select("*", F.explode(positions(0, F.col("n_lines"))).alias("k"))
        .groupBy("doc_id", "text_hash", (F.col("line") + F.col("k")).alias("line"))
        .agg(F.min(source).alias("source"))
    )
    # The texts of these lines and of those they repeat, whose own source is null.
    wanted = (
        gone.unionByName(gone.select("source.*", F.lit(None).cast(gone.schema["source"].dataType).alias("source")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("line", "source")).alias("wanted"))
    )
    w, t = (F.broadcast(wanted) if gone.count() <= BROADCAST_ROWS else wanted).alias("w"), texts.alias("t")
    picked = let(F.split("t.text", "\n", -1), lambda ls: F.transform("w.wanted", lambda x: F.struct(x["line"].alias("line"), x["source"].alias("source"), ls[x["line"]].alias("text"))))
    said = freeze(
        t.join(w, F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.text_hash") == F.col("w.text_hash")))
        .select("t.doc_id", "t.text_hash", F.explode(picked).alias("x"))
        .select("doc_id", "text_hash", "x.*")
    )
    first = said.where("source is null").dropDuplicates(["doc_id", "text_hash", "line"]).alias("f")
    again = said.where("source is not null").alias("a")
    same = F.col("a.source.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("a.source.text_hash") == F.col("f.text_hash")) & (F.col("a.source.line") == F.col("f.line"))
    return (
        again.join(first, same)
        .where("a.text = f.text")
        .select("a.doc_id", "a.text_hash", "a.line", F.char_length("a.text").alias("n_chars"), F.col("f.doc_id").alias("first_doc_id"))
    )


def dedup_lines(docs: DataFrame, lines: int = LINES, every: int = EVERY, min_words: int = MIN_WORDS, long: int = LONG) -> DataFrame:
    """``docs`` with ``text`` without its repeated passages, and the column ``removed``.

    ``removed`` holds n_removed (runs of lines that went), n_lines and n_chars of
    what went.  Null texts stay null, with zeros.  Texts without repeated passages
    stay as they are, byte for byte.
    """
    gone = freeze(
        repeated_lines(docs, lines, every, min_words, long)
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set(F.struct("line", "n_chars"))).alias("gone"))
        .select("doc_id", "text_hash", F.col("gone.line").alias("lines"), F.aggregate("gone.n_chars", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_chars"))
        .withColumn("n_removed", F.size(F.array_except("lines", F.transform("lines", lambda i: i + 1))).cast("long"))
        .withColumn("n_lines", F.size("lines").cast("long"))
        # Line ends between the lines of a run went with them.
        .withColumn("n_chars", F.col("n_chars") + F.col("n_lines") - F.col("n_removed"))
    )
    d = docs.withColumn("__hash", F.xxhash64("text")).alias("d")
    joined = d.join(broadcast_if_small(gone).alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.__hash") == F.col("g.text_hash")), "left")
    left = let(F.split("d.text", "\n", -1), lambda ls: F.array_join(F.transform(F.array_except(positions(0, F.size(ls)), "g.lines"), lambda i: ls[i]), "\n"))
    zero = F.lit(0).cast("long")
    removed = F.struct(*(F.coalesce(f"g.{c}", zero).alias(c) for c in ("n_removed", "n_lines", "n_chars"))).alias("removed")
    hit = F.col("g.text_hash").isNotNull()
    kept = [F.when(hit, left).otherwise(F.col("d.text")).alias("text") if c == "text" else F.col(f"d.`{c}`") for c in docs.columns if c != "removed"]
    return joined.select(*kept, removed)
