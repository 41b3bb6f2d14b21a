"""Secrets in texts: known patterns, and strings that a battery of tests finds random.

Base kinds are patterns.  Beside them every run of 20 characters or more of an
encoding's alphabet is a candidate, also beside characters of another encoding
(``NAME=VALUE``, paths): its encoding is inferred, and uniformity of
the alphabet (chi-squared), the number of runs about the median and the serial
correlation are tested.  What is controlled is the share of false discoveries
among strings called random: the null hypothesis is ordinary writing, whose
letters are as uneven as ``COINCIDENCE`` says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.llm.text import let, positions, running
from simquarry.session import freeze

# Kinds in their order, pattern, and what is measured and how long it must be.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex", "random")

LEAST = 20  # characters of a candidate
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}+"
# What has an encoding: the two widest alphabets hold the others.
ENCODED = r"^(?:[A-Za-z0-9+/]*|[A-Za-z0-9_-]*)=*$"
# Parts of a run between inner equals signs; those at its end are padding.
PART = r"[^=]++(?:=+$)?"

DIGITS = "0123456789"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Encodings from the narrowest alphabet to the widest.
ALPHABETS = {
    "decimal": DIGITS,
    "hex": DIGITS + "abcdef",
    "hex_upper": DIGITS + "ABCDEF",
    "base32": LETTERS + "234567",
    "base36": DIGITS + LETTERS.lower(),
    "base64": LETTERS + LETTERS.lower() + DIGITS + "+/",
    "base64_url": LETTERS + LETTERS.lower() + DIGITS + "-_",
}

# Sum of squared and of cubed letter shares in ordinary writing.
COINCIDENCE, COINCIDENCE3 = 0.066, 0.0056
FALSE_DISCOVERIES = 0.01
REJECT = 0.001  # the battery rejects randomness below this


def _phi(z: Column) -> Column:
    """The normal distribution function, by a logistic curve (error below 0.0002)."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.070565992 * z * z * z)))


def _two_sided(z: Column) -> Column:
    return 2 * _phi(-F.abs(z))


def _spans(kind: str, text: Column, pattern: str, least: int = 0, group: int = 0) -> Column:
    """(kind, start, stop) of each match, from the pieces between matches.

    Positions are code points.  ``least``: characters that ``group`` must have.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def place(m: Column, v: Column, gaps: Column) -> Column:
        sizes = F.transform(m, lambda x, i: F.struct(F.char_length(gaps[i]).alias("gap"), F.char_length(x).alias("match"), F.char_length(v[i]).alias("value")))
        empty = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
        start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

        def step(a: Column, s: Column) -> Column:
            begin = a["at"] + s["gap"]
            span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), (begin + s["match"]).alias("stop"))
            return F.struct((begin + s["match"]).alias("at"), F.when(s["value"] >= least, F.array_append(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

        return F.aggregate(sizes, start, step, lambda a: a["spans"])

    none = F.array().cast("array<struct<kind:string,start:int,stop:int>>")
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(let(values, lambda v: let(F.split(text, pattern, -1), lambda g: place(m, v, g)))))


def _class(alphabet: str) -> str:
    """The characters of ``alphabet`` as a class of a pattern."""
    return f"[{alphabet.replace('-', chr(92) + '-')}]"


def _pieces(value: Column) -> Column:
    """(kind, start, stop) of the candidates in a run, which may overlap.

    A run that has an encoding is one candidate.  Others are parted at inner
    equals signs, and parts without an encoding into the longest stretches of each
    alphabet.
    """
    whole = lambda v: F.array(F.struct(F.lit("random").alias("kind"), F.lit(0).alias("start"), F.char_length(v).alias("stop")))
    shift = lambda at, by: F.transform(at, lambda y: F.struct(y["kind"].alias("kind"), (y["start"] + by).alias("start"), (y["stop"] + by).alias("stop")))

    def stretches(v: Column) -> Column:
        each = F.concat(*(_spans("random", v, f"{_class(a)}{{{LEAST},}}+(?:=+$)?") for a in ALPHABETS.values()))
        return F.when(v.rlike(ENCODED), whole(v)).otherwise(F.array_distinct(each))

    parts = F.flatten(F.transform(_spans("random", value, PART), lambda y: shift(let(F.substring(value, y["start"] + 1, y["stop"] - y["start"]), stretches), y["start"])))
    return F.when(value.rlike(ENCODED), whole(value)).otherwise(parts)


def _joined(spans: Column) -> Column:
    """``spans`` (start, stop) by start, those that overlap as one."""

    def parts(s: Column, reach: Column) -> Column:
        """A part starts where no span before reaches, and ends with the furthest reach before the next."""
        first = F.filter(positions(0, F.size(s)), lambda i: F.when(i == 0, True).otherwise(s[i]["start"] >= reach[i - 1]))
        return let(first, lambda f: F.transform(f, lambda i, k: F.struct(s[i]["start"].alias("start"), reach[F.coalesce(F.get(f, k + 1), F.size(s)) - 1].alias("stop"))))

    return let(F.sort_array(spans), lambda s: let(let(s["stop"], lambda x: running(x, F.greatest)), lambda reach: parts(s, reach)))


def _touches(apart: Column, span: Column) -> Column:
    """Does ``span`` overlap one of ``apart``, which are in order and do not overlap?  The last that starts before its end is found by halving."""
    step = lambda k: F.call_function("shiftleft", F.lit(1), k)
    starts_before = lambda at: F.when(at <= F.size(apart), F.get(apart, at - 1)["start"] < span["stop"]).otherwise(False)
    steps = F.reverse(F.sequence(F.lit(0), F.length(F.bin(F.size(apart)))))
    n = F.aggregate(steps, F.lit(0), lambda at, k: F.when(starts_before(at + step(k)), at + step(k)).otherwise(at))
    return let(n, lambda at: F.when(at > 0, F.get(apart, at - 1)["stop"] > span["start"]).otherwise(False))


def _battery(value: Column) -> Column:
    """encoding, n, p_text and p_random of a candidate.

    ``p_text``: chance that ordinary writing of this length is as even as this.
    ``p_random``: the least of the three tests' p-values, times three.
    """
    core = F.regexp_replace(value, "=+$", "")
    encoding = F.coalesce(*(F.when(core.rlike(f"^{_class(a)}+$"), F.lit(e)) for e, a in ALPHABETS.items()))

    # What the tests use again and again is bound first: a lambda evaluates
    # what it captures at each element.
    def tests(s: Column) -> Column:
        alphabet = lambda e: F.create_map(*(F.lit(x) for kv in ALPHABETS.items() for x in kv))[e]
        return let(encoding, lambda e: let(alphabet(e), lambda a: let(F.char_length(s).cast("double"), lambda n: measured(s, e, a, n))))

    def measured(s: Column, e: Column, alphabet: Column, n: Column) -> Column:
        k = F.char_length(alphabet).cast("double")
        counts = F.transform(F.split(alphabet, ""), lambda c: n - F.char_length(F.replace(s, c, F.lit(""))))
        squares = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c)
        x = F.transform(F.split(s, ""), lambda c: F.instr(alphabet, c).cast("double"))
        mean_of = lambda v: F.aggregate(v, F.lit(0.0), lambda a, y: a + y) / n
        return let(squares, lambda q: let(x, lambda v: let(mean_of(v), lambda m: let((k + 1) / 2, lambda middle: numbers(e, n, k, q, v, m, middle)))))

    def numbers(e: Column, n: Column, k: Column, q: Column, v: Column, m: Column, middle: Column) -> Column:
        chi, df = k / n * q - n, k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        pairs = n * (n - 1)
        mean = k * (1 + (n - 1) * COINCIDENCE) - n
        sd = k / n * F.sqrt(2 * pairs * COINCIDENCE * (1 - COINCIDENCE) + 4 * pairs * (n - 2) * (COINCIDENCE3 - COINCIDENCE**2))

        # Neighbours are met in one fold that remembers the one before.
        start = F.struct(*(F.lit(0.0).alias(c) for c in ("n1", "changes", "between", "within")), F.lit(None).cast("double").alias("last"))

        def step(a: Column, y: Column) -> Column:
            changed = F.coalesce((y > middle) != (a["last"] > middle), F.lit(False))
            return F.struct(
                (a["n1"] + F.when(y > middle, 1.0).otherwise(0.0)).alias("n1"),
                (a["changes"] + F.when(changed, 1.0).otherwise(0.0)).alias("changes"),
                (a["between"] + F.coalesce((y - m) * (a["last"] - m), F.lit(0.0))).alias("between"),
                (a["within"] + (y - m) * (y - m)).alias("within"),
                y.alias("last"),
            )

        def series(r: Column) -> Column:
            n1, n0 = r["n1"], n - r["n1"]
            runs = 1 + r["changes"]
            mu = 1 + 2 * n1 * n0 / n
            var = F.greatest((mu - 1) * (mu - 2) / (n - 1), F.lit(1e-9))
            serial = F.when(r["within"] > 0, r["between"] / r["within"]).otherwise(1.0)
            return F.least(F.lit(1.0), 3 * F.least(1 - _phi(z_chi), _two_sided((runs - mu) / F.sqrt(var)), _two_sided(serial * F.sqrt(n))))

        return F.struct(e.alias("encoding"), n.cast("int").alias("n"), _phi((chi - mean) / sd).alias("p_text"), let(F.aggregate(v, start, step), series).alias("p_random"))

    return let(core, tests)


def _band(n: Column) -> Column:
    """Length bands in which discoveries are controlled on their own: the power of the tests grows with length."""
    return F.least(F.floor(F.log2(n.cast("double")) * 2), F.lit(20)).cast("int")


def scan(docs: DataFrame, false_discoveries: float = FALSE_DISCOVERIES) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id and ``spans``, by start, then kind as in ``KINDS``.

    Null texts are empty.  Spans of ``random`` never touch a base span; called
    candidates that overlap are one span.  Whether
    a string is called random depends on all candidates of the corpus: within a
    family (encoding and length band), the largest p-value ``p_text`` is found
    whose expected false discoveries are at most ``false_discoveries`` of those
    called (Benjamini and Hochberg, on tenths of a decade).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = F.concat(_spans("assign", text, ASSIGN, 6, 2), _spans("access", text, ACCESS), _spans("hex", text, HEX))
    bounds = lambda at: F.transform(at, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop")))
    free = lambda b, at: let(_joined(bounds(b)), lambda apart: F.filter(at, lambda s: ~_touches(apart, s)))
    values = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    # A piece is cut from its run, not from the text, which would be walked for each.
    of_run = lambda at, value: F.transform(
        _pieces(value), lambda y: F.struct((at + y["start"]).alias("start"), (at + y["stop"]).alias("stop"), F.substring(value, y["start"] + 1, y["stop"] - y["start"]).alias("value"))
    )
    pieces = let(values, lambda v: F.flatten(F.transform(_spans("random", text, CANDIDATE), lambda s, i: let(v[i], lambda value: of_run(s["start"], value)))))
    long_enough = F.filter(pieces, lambda s: s["stop"] - s["start"] >= LEAST)
    candidates = lambda b: F.when(
        F.size(values) == 0, F.array().cast("array<struct<start:int,stop:int,encoding:string,n:int,p_text:double,p_random:double>>")
    ).otherwise(
        F.filter(
            F.transform(
                free(b, long_enough),
                lambda x: let(_battery(x["value"]), lambda t: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), t["encoding"].alias("encoding"), t["n"].alias("n"), t["p_text"].alias("p_text"), t["p_random"].alias("p_random"))),
            ),
            lambda c: c["encoding"].isNotNull() & (c["n"] >= LEAST),
        )
    )
    seen = freeze(docs.select("doc_id", let(base, lambda b: F.struct(b.alias("base"), candidates(b).alias("candidates"))).alias("x")).select("doc_id", "x.*"))

    family = lambda c: F.concat_ws(":", c["encoding"], _band(c["n"]).cast("string"))
    tenth = lambda p: F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-30)))), F.lit(300)).cast("int")
    # At most encodings x 21 bands x 301 tenths rows, then one number for each family.
    counts = (
        seen.select(F.explode("candidates").alias("c"))
        .groupBy(family(F.col("c")).alias("family"), tenth(F.col("c.p_text")).alias("tenth"))
        .count()
        .groupBy("family")
        .agg(F.sort_array(F.collect_list(F.struct("tenth", "count"))).alias("at"))
    )
    total = F.aggregate("at", F.lit(0).cast("long"), lambda a, y: a + y["count"])
    called = lambda t: F.aggregate("at", F.lit(0).cast("long"), lambda a, y: a + F.when(y["tenth"] >= t, y["count"]).otherwise(0))
    # The largest p of a tenth is 10^(-tenth/10).
    fits = F.filter("at", lambda y: F.pow(F.lit(10.0), -y["tenth"] / 10.0) * total <= false_discoveries * called(y["tenth"]))
    cuts = {r["family"]: r["cut"] for r in counts.select("family", F.array_min(F.transform(fits, lambda y: y["tenth"])).alias("cut")).where("cut is not null").collect()}
    cut = F.create_map(*(F.lit(x) for kv in sorted(cuts.items()) for x in kv)) if cuts else F.create_map().cast("map<string,int>")
    random = F.filter("candidates", lambda c: (c["p_random"] >= REJECT) & F.coalesce(tenth(c["p_text"]) >= cut[family(c)], F.lit(False)))
    more = F.transform(
        _joined(F.transform(random, lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop")))),
        lambda c: F.struct(F.lit("random").alias("kind"), c["start"].alias("start"), c["stop"].alias("stop")),
    )
    rank = lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)
    ordered = F.transform(
        F.sort_array(F.transform(F.concat("base", more), lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")),
    )
    return seen.select("doc_id", ordered.alias("spans"))
