"""Collocations, periodic runs and segment-tree encoding against brute force and the library."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from simquarry.llm import collocations, runs, segment_bpe
from simquarry.llm.queries import QUERIES, ORACLE
from tests.compare import duck, run

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF_DIR = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "\x1c x\x85y\xa0z", "don't  stop\n\n\tnow ", "naïve café 12³ ½", "日本語 テキスト é Σίσυφος", "<|endoftext|>a", "aaaa" * 500, "🙂 \U0001f468‍\U0001f469", "x" * 3000 + " end", "՘꟎ \U0001fae9 ༳"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=segment_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return segment_bpe.Encoder(RANKS, public_tokenizers.PATTERN)


def brute_phrases(rows, longest, min_count, top, covered):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            own.update(tuple(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        scored = []
        for p, a in often.items():
            score, _, l, r = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            inside = any(len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= covered * a for q, b in often.items())
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("longest", "min_count", "top", "covered"), [(5, 3, 1000, 100), (5, 2, 7, 100), (4, 3, 1000, 60), (2, 1, 1000, 100)])
def test_collocations(spark, longest, min_count, top, covered):
    rng = random.Random(longest * min_count)
    words = ["a", "B", "é", "x\x1cy", "a-b", " ", "w", "W", "q1", "q2", "q3"]
    rows = [(None, None, 1), ("en", "", 1), ("en", " \t.,\r\n", 1), ("und", "One\ttwo  one two.", 1), (None, "one TWO one two one two", 1), ("de", "z " * 300, 1)]
    for k in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\x0b", "!"]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "en", "de", None]), text + ("so it is said here" if k % 3 else "it is said"), 1))
    rows += rows[7:9]
    df = spark.createDataFrame(rows, "lang string, text string, words int")
    got = sorted(tuple(r) for r in collocations.collocations(df, longest, min_count, top, covered).collect())
    assert got == brute_phrases([r[:2] for r in rows], longest, min_count, top, covered)


def test_collocations_of_huge_numbers(spark, monkeypatch):
    """1000 a n passes 64 bits; the scores stay exact."""
    big = 10**14
    monkeypatch.setattr(collocations, "word_counts", lambda cut, least: spark.createDataFrame([("en", None, 3 * big + 1), ("en", "x", big), ("en", "y", big - 7)], "lang string, word string, n long"))
    monkeypatch.setattr(collocations, "phrase_counts", lambda found, longest, least: spark.createDataFrame([("en", ["x", "y"], big - 9)], "lang string, words array<string>, n long"))
    r = collocations.collocations(spark.createDataFrame([("en", "x y")], "lang string, text string")).first()
    assert r["score"] == 1000 * (big - 9) * (3 * big + 1) // (big * (big - 7))


def test_a_full_sieve_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SIEVE_MIN", 64)
    monkeypatch.setattr(collocations, "SIEVE_MAX", 64)
    rows = [("en", f"w{k} v{k} u{k % 5} " * 4) for k in range(100)]
    got = sorted(tuple(r) for r in collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), 5, 3).collect())
    assert got == brute_phrases(rows, 5, 3, 2000, 100)


def test_a_sieve_is_not_in_the_text_of_plans(spark, monkeypatch):
    """The driver keeps the text of each plan, and a bitmap of 2 MB was in it a dozen times as a list of numbers."""
    monkeypatch.setattr(collocations, "SIEVE_MIN", 1 << 20)
    hashes = spark.range(500).select(F.xxhash64("id").alias("hash"))
    may = collocations.sieve(hashes)
    cut = collocations.pieces(spark.createDataFrame([("en", "a b c d e f")], "lang string, text string"))
    found = collocations.windows(cut, may, may, 5)
    assert len(found._jdf.queryExecution().toString()) < 100_000
    passed = spark.range(2000).select("id", F.xxhash64("id").alias("hash")).where(may(F.col("hash")))
    assert len(passed._jdf.queryExecution().toString()) < 10_000
    assert 500 <= passed.count() < 510 and passed.where("id < 500").count() == 500


def brute_runs(w, shortest):
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, size = i, j - i + q
            if size >= max(shortest, 2 * q) and not any(all(w[start + k] == w[start + k + p] for k in range(size - p)) for p in range(1, q)):
                out.append((start, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("shortest", [2, 5, 12])
def test_runs(shortest):
    rng = random.Random(shortest)
    for _ in range(150):
        texts = []
        for _ in range(rng.randrange(5)):
            letters = rng.choice([1, 2, 3, 6, 30])
            w = [b"%d" % rng.randrange(letters) for _ in range(rng.randrange(60))]
            a = rng.randrange(len(w) + 1)
            texts.append(w[:a] + (w[a : a + rng.randrange(1, 9)] * 12)[: len(w) - a])
        assert runs.find_runs(texts, shortest) == [brute_runs(w, shortest) for w in texts]


def test_long_texts_of_one_word_and_of_few():
    assert runs.find_runs([[b"a"] * 200_000, [], [b"x"] * 11]) == [[(0, 200_000, 1)], [], []]
    rng = random.Random(0)
    part = [b"%d" % rng.randrange(3) for _ in range(30_000)]
    found = runs.find_runs([part * 3])[0]
    assert (0, 90_000, 30_000) in found


def expected_runs(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, 12)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{size},{q}\n" for s, size, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_of_runs(spark):
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(table)
    short = [r for r in rows if len(table[r["doc_id"]] or "") < 8000]
    assert any(r["n_runs"] for r in short)
    for r in short:
        assert tuple(r)[1:] == expected_runs(r["doc_id"], table[r["doc_id"]])


def test_runs_of_odd_rows(spark):
    rows = [(1, None, 9), (1, None, 9), (None, "k " * 13, 9), (2, "", 9), (3, "\x1c\x85 " * 12 + "\xa0", 9), (4, "a b\tc\n" * 4, 9)]
    got = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs int"), ["doc_id"]).collect()
    found = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got)
    assert found == [(0, [(0, 13, 1)], "k"), (1, [], ""), (1, [], ""), (2, [], ""), (3, [(0, 12, 1)], "\x1c\x85 \xa0"), (4, [(0, 12, 3)], "a b c")]


def test_segment_tree_is_the_library(library, encoder):
    rng = random.Random(5)
    odd = [chr(c) for c in [*range(1, 0x250), *(rng.randrange(0x250, 0xD800) for _ in range(500)), *(rng.randrange(0x10000, 0x110000) for _ in range(200))]]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(rng.choice([odd, "ab '\ns t"])) for _ in range(rng.randrange(80))) for _ in range(600)]
    texts += ["".join(rng.choice("aeinrst") for _ in range(n)) for n in (1, 2, 3, 4, 5, 16, 17, 63, 64, 65, 130, 20_000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        own = np.frombuffer(ids, "<u4").tolist()
        assert own == library.encode_ordinary(text), text
        assert encoder.decode(own) == text.encode()


def test_one_tree_and_many_agree(encoder):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefé") for _ in range(rng.randrange(2, 30))).encode() for _ in range(300)]
    words = [w for w in words if len(w) <= 64]
    for word, ids in zip(words, encoder.forest.merge(words, 64), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == segment_bpe.merge(word, encoder.ranks)


def test_a_worker_that_forgets(library, monkeypatch):
    monkeypatch.setattr(segment_bpe, "MAX_KNOWN", 5)
    own = segment_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for k in range(4):
        texts = [f"word{k * j} other, thing{j}" for j in range(9)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_encode_and_decode(spark, library):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "no id", 1), (3, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = segment_bpe.encode(df, RANKS, public_tokenizers.PATTERN, ["doc_id", "text"])
    for r in got.collect():
        assert r["ids"] == library.encode_ordinary(r["text"] or "")
    for r in segment_bpe.decode(got, RANKS, public_tokenizers.PATTERN, ["text"]).collect():
        assert bytes(r["bytes"]) == (r["text"] or "").encode()


def test_query_of_segment_trees(spark, library):
    table = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op12_segment_bpe"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(table)
    for r in rows:
        text = table[r["doc_id"]]
        ids = library.encode_ordinary(text)
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_query_of_collocations(spark):
    message, ok = run(spark, duck(SF_DIR), SF_DIR, "op11", QUERIES["op11_phrase_collocations"], ORACLE["op11_phrase_collocations"])
    assert ok, message
    assert "EMPTY" not in message


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(none).count() == 0
    assert runs.periodic_runs(none, plant=True).count() == 0
    assert segment_bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert segment_bpe.digests(none, RANKS, public_tokenizers.PATTERN).count() == 0
