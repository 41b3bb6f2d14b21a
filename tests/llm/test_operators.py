"""The operators on small tables, against plain Python."""

from __future__ import annotations

import hashlib
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from simquarry.llm import bpe, chat, components, decontam, jaccard, language, line_dedup, quality, secrets, token_files, warc

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
ODD = [None, "", " ", "a", "\x1c x\x85y\xa0z", "don't  stop\n\n\tnow ", "naïve café 12³ ½", "日本語 テキスト é Σίσυφος", "<|endoftext|>a<|endoftext|>", "aaaa" * 500, "🙂 \U0001f468‍\U0001f469", "x" * 3000 + " end"]


@pytest.fixture()
def docs(spark):
    """Odd texts with ids, a null id, a repeated row, and an extra column of a clashing name."""
    rows = [(i, t, "k") for i, t in enumerate(ODD)] + [(None, "no id", "k"), (3, "a", "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, node string")


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_memory_of_an_encoder_is_bounded(monkeypatch):
    """It outlives its tasks: pairs and words beyond the bounds go, those of the batch stay, and ids are the same."""
    for name, most in (("MAX_WORDS", 60), ("MAX_PAIRS", 40)):
        monkeypatch.setattr(bpe, name, most, raising=False)
    rnd = random.Random(3)
    batches = [[" ".join(["the same words", *("".join(rnd.choices("etaoinshr", k=9)) for _ in range(20))])] for _ in range(12)]
    own, library = bpe.Encoder(BYTE), Tokenizer.from_file(BYTE)
    own.voc.follows.clear()
    for k, texts in enumerate(batches):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(own.voc.follows) <= 40
        assert max(len(own.known), len(own.trie.known)) <= 60
        assert not k or " same" in own.known


def test_an_encoder_forgets_what_it_has_not_met_for_longest(monkeypatch):
    """Words of every second batch stay although the memory is full, also beside texts that go whole."""
    monkeypatch.setattr(bpe, "MAX_WORDS", 60)
    monkeypatch.setattr(bpe, "MAX_BYTES", 4000)
    rnd = random.Random(5)
    own, library = bpe.Encoder(BYTE), Tokenizer.from_file(BYTE)
    for k in range(20):
        texts = [f"now {'often' if k % 2 else 'seldom'} x{k}, don't", "日本語 " + "".join(rnd.choices("etaoin", k=9)), " ".join("".join(rnd.choices("etaoinshr", k=9)) for _ in range(8)), "now often's end", "z" * 200 * (k % 3)]
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert own.trie.size == sum(len(w) + len(ids) for w, ids in own.known.items())
        assert k < 2 or {" often", " seldom"} <= own.known.keys()
        assert len(own.known) <= 70 and own.trie.size <= 6000


def test_pairs_of_tokens_need_no_merging(monkeypatch):
    """The last merges of two tokens tell whether one may follow the other; the bytes of neither are merged again."""
    rnd = random.Random(4)
    words = ["".join(rnd.choices("etaoinshrdlu'.,éß日", k=rnd.randrange(1, 12))) for _ in range(3000)] + ["a" * k for k in range(1, 40)] + ["=" * 300, "\u0301" * 50]
    own, library = bpe.Encoder(BYTE), Tokenizer.from_file(BYTE)
    own.voc.follows.clear()
    with monkeypatch.context() as m:
        m.setattr(bpe.Vocabulary, "merge", lambda *_: pytest.fail("bytes are merged"))
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch([" ".join(words), *words])]
        bpe.Vocabulary(BYTE)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in (" ".join(words), *words)]
    voc = own.voc
    tokens = sorted(i for x in set(voc.ends) for i in x)
    for a, b in [*voc.ranks][::500] + [(rnd.choice(tokens), rnd.choice(tokens)) for _ in range(3000)]:
        assert voc.may_follow(a, b) == (voc.merge(voc.bytes_of[a] + voc.bytes_of[b]) == [a, b]), (a, b)


@pytest.mark.parametrize(
    "merges",
    [
        ["ab c", "a b", "b c", "c a", "bc a", "c ab"],  # a merge before the one that yields its part
        ["a b", "b c", "ab c", "a bc", "abc abc", "c c", "cc c", "a a", "aa aa", "aa a"],  # two ways to one token
        ["a a", "aa aa", "aaaa a", "b a", "aa b", "c b", "b b"],
    ],
)
def test_vocabularies_of_few_merges(tmp_path, merges):
    with open(BYTE, encoding="utf-8") as f:
        model = json.load(f)
    tokens = [*bpe.byte_letters(), *dict.fromkeys(m.replace(" ", "") for m in merges)]
    model["added_tokens"] = []
    model["model"]["vocab"] = {t: k for k, t in enumerate(tokens)}
    model["model"]["merges"] = [m.split(" ") for m in merges] if isinstance(model["model"]["merges"][0], list) else merges
    path = str(tmp_path / "few.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(model, f)
    own, library = bpe.Encoder(path), Tokenizer.from_file(path)
    rnd = random.Random(6)
    texts = ["".join(rnd.choices("abc", k=rnd.randrange(1, 30))) for _ in range(2000)]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_letters_are_one_word():
    """Chunks of letters are not put to the pattern: each character with others beside it is the library's."""
    own, library = bpe.Encoder(BYTE), Tokenizer.from_file(BYTE)
    texts = [f"{a}{chr(c)}{b}" for c in range(0x260) for a, b in (("", ""), ("a", "X"), (" ", "b"), (" 1", "'t"))]
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_shingles_counted_in_place():
    rnd = np.random.default_rng(5)
    for least in (2, 3, 7):
        sets = {k: np.unique(rnd.integers(0, 60, n).astype(np.uint64)) for k, n in enumerate((40, 1, 25, 50, 30, 3, 60))}
        token, seen = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        got = jaccard._often(sets, least)
        assert got[0].tolist() == token[seen >= least].tolist() and got[1].tolist() == seen[seen >= least].tolist()
        assert not sets
    assert jaccard._often({1: np.array([4], np.uint64)}, 2)[0].tolist() == []


def shingle_lists(texts: list[str | None]) -> list[list[int]]:
    out = []
    for _, data, bounds in jaccard._pieces(pa.array([None, *texts, None], pa.string()).slice(1, len(texts))):
        s, at = jaccard.shingle_sets(data, bounds)
        out += [s[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    return out


@pytest.mark.parametrize("piece", [1, 300, 1 << 19])
def test_shingles_of_texts_side_by_side(monkeypatch, piece):
    """Each different run of words has one hash of its own, whatever stands in the texts beside it."""
    monkeypatch.setattr(jaccard, "PIECE", piece)
    rnd = random.Random(3)
    parts = ["a", "B", " ", "\t", "\n", "\x0b", "\x0c", "\0", "\x1c", "é", "\xa0", "\x85", "x" * 8, "y" * 31, "z" * 64, "q" * 65, "  "]
    texts = [None, "", " ", "a", "A b", "a b\0", *("".join(rnd.choices(parts, k=rnd.randrange(60))) for _ in range(300)), "a b c d e " * 40, ""]
    words = [(t or "").encode().lower().split() for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()} for w in words]
    single = sorted(set().union(*sets))
    named = dict(zip(single, (x for (x,) in shingle_lists([b" ".join(s).decode() for s in single])), strict=True))
    assert len(set(named.values())) == len(single)
    assert shingle_lists(texts) == [sorted(named[x] for x in s) for s in sets]


def test_shingles_without_a_call_for_each_word(monkeypatch):
    calls, digest = [], jaccard.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(jaccard.xxhash, "xxh3_64_intdigest", lambda x, **k: calls.append(len(x)) or digest(x, **k))
    texts = [" ".join(f"w{i}x{k}" for k in range(500)) for i in range(10)]
    assert [len(s) for s in shingle_lists(texts)] == [496] * 10
    assert len(calls) == 0


def test_bitmaps_of_sets():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 1 << 64, n, np.uint64)) for n in (0, 1, 512, 513, 0, 2048, 7)]
    s, at = np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])]
    narrow = jaccard._bitmaps(s, at)
    for x, bits, wide in zip(sets, narrow, jaccard._wide_bitmaps(s, at).to_pylist(), strict=True):
        assert np.flatnonzero(np.unpackbits(bits.view(np.uint8))).tolist() == sorted({int(v) >> 48 & 511 for v in x})
        if not len(x):
            assert wide is None
            continue
        width = max(512, 1 << (len(x) - 1).bit_length())
        assert len(wide) * 8 == width
        assert np.flatnonzero(np.unpackbits(np.frombuffer(wide, np.uint8), bitorder="little")).tolist() == sorted({int(v) % width for v in x})


def test_bpe_is_the_library(docs):
    library = Tokenizer.from_file(BYTE)
    got = bpe.encode(docs, BYTE, ["doc_id", "text"])
    for r in got.collect():
        assert r["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids, r["text"]
    for r in bpe.decode(got.withColumnRenamed("text", "was"), BYTE, ["was"]).collect():
        assert r["text"] == (r["was"] or "")


def test_word_ids_are_the_library():
    library = Tokenizer.from_file(WORD)
    texts = [t or "" for t in ODD]
    ids, ends = token_files.WordEncoder(WORD).encode(texts, [7])
    for text, a, b in zip(texts, [0, *ends], ends, strict=False):
        assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 7], text


def test_each_character_alone_and_between_letters_is_the_library():
    library = Tokenizer.from_file(WORD)
    texts = [f"{a}{chr(c)}{b}" for c in range(0x260) for a, b in (("", ""), ("a", "X"), (" 1", "'t"))]
    ids, ends = token_files.WordEncoder(WORD).encode(texts)
    for text, a, b in zip(texts, [0, *ends], ends, strict=False):
        assert ids[a:b].tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_runs_of_letters_and_signs_are_the_library():
    library = Tokenizer.from_file(WORD)
    rng = random.Random(7)
    signs = ["a", "b", "th", "Ing", "é", "ß", "1", "42", "'", "'s", "'T", ".", ",", ")(", "-", "_", "²", "İ", " ", "\t", "\x1d", "§"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(800)]
    ids, ends = token_files.WordEncoder(WORD).encode(texts, [7])
    for text, a, b in zip(texts, [0, *ends], ends, strict=False):
        assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 7], text


def test_token_files(spark, docs):
    """Everything of the digests from the files, against the library."""
    library = Tokenizer.from_file(WORD)
    docs = docs.unionByName(docs.where("doc_id = 6"))
    folder = token_files.new_folder(docs)
    token_files.write(docs, WORD, folder)
    rows = token_files.digests(token_files.read(spark, folder)).orderBy("start").collect()
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda x: (x is not None, x))
    want = []
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, token_files.END_ID]
        want.append((r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows), key=str) == sorted(want, key=str)


def test_token_files_are_pruned(spark):
    """A lookup reads the row groups that may hold the ids, not the files."""
    n = 40 * token_files.STRIDE
    docs = spark.range(0, 2 * n, 2).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    folder = token_files.new_folder(docs)
    token_files.write(docs, WORD, folder)

    def scanned(found):
        rows = found.collect()
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return sorted(r["doc_id"] for r in rows), scan.metrics().apply("numOutputRows").value()

    ids, read = scanned(token_files.lookup(spark, folder, [10, n]))
    assert ids == [10, n] and read <= 2 * token_files.STRIDE + 4096
    ids, read = scanned(token_files.lookup(spark, folder, [2 * n + 1, -5]))
    assert ids == [] and read == 0
    # An odd id lies within the range of a file; only the Bloom filter knows that it is not there.
    ids, read = scanned(token_files.lookup(spark, folder, [n + 1]))
    assert ids == [] and read <= token_files.STRIDE


def brute_groups(texts: dict[int, str | None]) -> dict[int, int]:
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    sets, label = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return label


@pytest.mark.parametrize("block", [1024, 4])
def test_similar_groups(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(block)
    texts: dict[int, str | None] = {0: None, 1: "", 2: "one two", 3: "ONE two"}
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    for i in range(4, 40):
        words = list(base) if i % 3 else [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 90))]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9999)}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, block int")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_groups(df).collect()}
    assert got == brute_groups(texts)


def test_blocks_of_a_hot_shingle(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rows = [(5, n) for n in range(50)] + [(6, 1), (6, 2), (6, 2), (7, 3), (8, 1), (8, 2)]
    got = jaccard._blocks(spark.createDataFrame(rows, "token long, node long")).collect()
    large = [r for r in got if r["chunk"] >= 0]
    assert sorted(r["node"] for r in large) == list(range(50)) and max(r["chunk"] for r in large) == 7
    assert sorted(r["node"] for r in got if r["chunk"] < 0) == [1, 2]  # two shingles of the same sets are one block


def test_components(spark):
    edges = [(k + 1, k) for k in range(20)] + [(40, 50), (50, 45), (None, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(21)} | {40: 40, 45: 40, 50: 40}


def test_decontamination(spark):
    item = [f"b{k}" for k in range(30)]
    docs = spark.createDataFrame([(1, "x " + " ".join(item[5:16]).upper() + " y"), (2, " ".join(item[:9])), (3, "see short one here"), (4, None), (None, " ".join(item)), (1, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "short one"), (9, None), (10, " ".join(item))], "item_id long, text string")
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["item_ids"]) for r in decontam.decontaminate(docs, bench).collect()}
    assert got == {(1, 13): (11, ["10", "7"]), (2, 9): (0, []), (3, 4): (2, ["8"]), (4, 0): (0, []), (None, 30): (30, ["10", "7"]), (1, 1): (0, [])}


def test_line_dedup_keeps_the_first(spark):
    passage = "\n".join(" ".join(f"l{k}w{j}" for j in range(12)) for k in range(12))
    df = spark.createDataFrame([(2, "own start\n" + passage + "\nown end", 5), (1, passage, 5), (3, None, 5), (4, "", 5), (5, "a b\nc d", 5)], "doc_id long, text string, removed int")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[1]["text"] == passage and got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "a b\nc d"
    assert got[2]["removed"]["n_removed"] > 0 and got[2]["text"].startswith("own start") and got[2]["text"].endswith("own end")


def test_line_dedup_of_long_lines(spark):
    long, short = (" ".join(f"{p}{k}" for k in range(n)) for p, n in (("w", 51), ("v", 50)))
    rows = [(k, f"before {k}\n{long}\nafter {k}") for k in range(6)] + [(9, long), (10, f"one {short}\n{long}\n{long}"), (11, f"a\n{short}\nb"), (12, f"c\n{short}\nd")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert got[0] == rows[0][1] and got[9] == ""
    assert all(got[k] == f"before {k}\nafter {k}" for k in range(1, 6))
    assert got[10] == f"one {short}"
    assert got[11] == rows[8][1] and got[12] == rows[9][1]


@pytest.mark.parametrize(("n_lines", "n_words"), [(2, 40), (3, 20), (3, 40), (4, 13), (6, 10)])
def test_line_dedup_of_short_lines(spark, n_lines, n_words):
    rows = []
    for k in range(20):
        passage = "\n".join(" ".join(f"p{k}l{i}w{j}" for j in range(n_words)) for i in range(n_lines))
        rows += [(100 * d + k, f"{d} before {k}\n{passage}\n{d} after {k}") for d in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert all(got[i]["text"] == text for i, text in rows if i < 100)
    for i, text in rows:
        if i >= 100:
            parts = text.split("\n")
            assert got[i]["text"] == f"{parts[0]}\n{parts[-1]}"
            assert tuple(got[i]["removed"]) == (1, n_lines, len("\n".join(parts[1:-1])))


def brute_lines(texts: list[str], long: int) -> list[str]:
    """Texts without every run of lines of ``long`` words that stands earlier."""
    split, out = [t.split("\n") for t in texts], []
    for d, ls in enumerate(split):
        gone = set()
        for a in range(len(ls)):
            for b in range(a + 1, len(ls) + 1):
                run = ls[a:b]
                if sum(len(x.split()) for x in run) >= long and any(e[c : c + b - a] == run for k, e in enumerate(split[: d + 1]) for c in range(len(e) if k < d else a - (b - a) + 1)):
                    gone |= {*range(a, b)}
        out.append("\n".join(x for i, x in enumerate(ls) if i not in gone))
    return out


def test_line_dedup_removes_whole_runs(spark):
    rng = random.Random(6)
    texts = []
    for k in range(60):
        own = lambda: [" ".join(f"w{rng.randrange(3)}" for _ in range(rng.choice([0, 1, 1, 2, 3]))) for _ in range(rng.randrange(1, 9))]
        shared = rng.choice(texts).split("\n") if texts else []
        a = rng.randrange(len(shared) + 1)
        texts.append("\n".join([*own(), *shared[a : a + rng.randrange(9)], *own()]))
    texts.append("\n".join(["x y"] * 20))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, min_words=10**6, long=6).collect()}
    assert [got[k] for k in range(len(texts))] == brute_lines(texts, 6)


@pytest.mark.parametrize("long", [4, 1000])
def test_line_chunks_are_whole_and_shift_resistant(spark, long):
    rng = random.Random(long)
    lines = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(7))) for _ in range(60)]
    texts = ["\n".join(lines), "\n".join(["other", *lines[5:]]), "", "\n", "one"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    got = {r["k"]: r["c"] for r in df.select("k", line_dedup._chunks(F.col("text"), 2, 3, long).alias("c")).collect()}
    for k, text in enumerate(texts):
        assert "\n".join(c["text"] for c in got[k]) == text
        assert all(c["n_lines"] == c["text"].count("\n") + 1 for c in got[k])
        assert [c["chunk"] for c in got[k]] == list(range(len(got[k])))
        assert all(c["n_lines"] == 1 for c in got[k] if any(len(x.split()) >= long for x in c["text"].split("\n")))
    first, second = ([c["text"] for c in got[k]] for k in (0, 1))
    assert len(first) > 5 and first[-3:] == second[-3:]


def test_quality_ledger(spark, docs):
    rows = quality.measure(docs.withColumn("quality", F.lit(1))).select("text", "quality.*").collect()
    assert {r["n_words"] for r in rows if not (r["text"] or "").strip()} == {0}
    text = "a b c a b c x"
    m = quality.measure(spark.createDataFrame([(text,)], "text string")).first()["quality"]
    assert (m["n_words"], m["n_repeat_words"]) == (7, 6)
    told = {r["rule"]: r for r in quality.ablations(quality.measure(docs), quality.FULL).collect()}
    assert told["few_words"]["n_failed"] == len(rows)


def test_secrets(spark, docs):
    key = hashlib.sha256(b"x").hexdigest()
    df = spark.createDataFrame([(1, f"é password: 'abc' token=secret99 AKIA{'Z9' * 8} {key}"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in secrets.scan(df).collect()}
    assert got == {1: [("assign", 18, 32), ("access", 33, 53), ("hex", 54, 118)], 2: []}
    assert secrets.scan(docs).count() == docs.count()


@pytest.mark.parametrize(
    ("before", "after"),
    [("AWS_SECRET_ACCESS_KEY=", ""), ("client_id=", "=="), ("sig=", ""), ("a=b=", "="), ("path/with_underscore/", ""), ("key-id_/", ""), ("", "-_/x"), ("", "")],
)
def test_secrets_beside_other_encodings(spark, before, after):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice(secrets.ALPHABETS["base64"].rstrip("+/")) for _ in range(40 + k % 3))) for k in range(40)]
    df = spark.createDataFrame([(k, f"é see {before}{key}{after} and go") for k, key in rows], "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["stop"]) for s in r["spans"]] for r in secrets.scan(df).collect()}
    found = 0
    for k, key in rows:
        start, stop = 6 + len(before), 6 + len(before) + len(key)
        assert len(got[k]) <= 1
        for kind, a, b in got[k]:
            assert kind == "random" and 6 <= a <= start and stop <= b <= stop + len(after)
            assert "=" not in before or a == start
            found += 1
    assert found >= 32


def test_names_are_not_secrets(spark):
    names = ["/path/to_some/ordinary-file/in_a_folder", "the_first_setting=another-ordinary/value_of_it", "some_long/path=with-many_ordinary/words_inside"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(names * 5)], "doc_id long, text string")
    assert all(r["spans"] == [] for r in secrets.scan(df).collect())


def test_secrets_of_a_text_of_many(spark):
    """Thousands of base spans and candidates in one text, each where it stands."""
    rng = random.Random(3)
    pairs = [(rng.randbytes(9).hex(), "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=40))) for _ in range(6000)]
    text = "\n".join(f"é token={a} {b}" for a, b in pairs)
    (row,) = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    base = [text[s["start"] : s["stop"]] for s in row["spans"] if s["kind"] == "assign"]
    assert base == [f"token={a}" for a, _ in pairs]
    called = [text[s["start"] : s["stop"]] for s in row["spans"] if s["kind"] == "random"]
    assert len(called) > 0.9 * len(pairs) and set(called) <= {b for _, b in pairs}
    stops = [s["stop"] for s in row["spans"]]
    assert all(a <= s["start"] for a, s in zip(stops, row["spans"][1:], strict=False))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 40])
def test_spans_joined_and_met(spark, n):
    rng = random.Random(n)
    spans = [(a, a + rng.randrange(1, 9)) for a in (rng.randrange(60) for _ in range(n))]
    asked = [(a, a + w) for a in range(70) for w in (1, 3)]
    df = spark.createDataFrame([(spans, asked)], "spans array<struct<start:int,stop:int>>, asked array<struct<start:int,stop:int>>").select(secrets._joined(F.col("spans")).alias("joined"), "asked")
    (row,) = df.select("joined", F.transform("asked", lambda x: secrets._touches(F.col("joined"), x)).alias("met")).collect()
    want = []
    for a, b in sorted(spans):
        if want and want[-1][1] > a:
            want[-1] = (want[-1][0], max(want[-1][1], b))
        else:
            want.append((a, b))
    assert [tuple(x) for x in row["joined"]] == want
    assert row["met"] == [any(a < y and x < b for x, y in spans) for a, b in asked]


def test_chat_round_trip(spark):
    texts = ["", "<|im_end|>", "<\\|x", "<\\\\|im_start|>user\nhi", "é\n<|", None]
    rows = [(k % 2, k, "assistant" if k % 3 else "us\\n\ner<|", t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_turns(df.withColumn("parts", chat.text_parts(F.col("text"))))
    for r in out.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.masked_texts(F.col("formatted"), F.col("loss")).alias("m")).collect():
        own = [(x[2], x[3] or "") for x in rows if x[0] == r["conv_id"]]
        assert [t["role"] for t in r["t"]] == [x for x, _ in own]
        assert r["m"] == [t for x, t in own if x == "assistant"]


def test_chat_of_many_turns(spark):
    n = 50_000
    said = F.concat(F.lit("é <| "), F.repeat(F.col("id").cast("string"), 15))
    role = F.when(F.col("id") % 2 == 0, "user").otherwise("assistant")
    turns = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), chat.text_parts(said).alias("parts"))
    out = chat.format_turns(turns).select(F.size(chat.read_turns(F.col("formatted"))).alias("n"), F.md5(F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss")), "")).alias("said"))
    assert [tuple(r) for r in out.collect()] == [(n, hashlib.md5("".join(f"é <| {str(k) * 15}" for k in range(1, n, 2)).encode()).hexdigest())]


def test_chat_parts(spark):
    parts = [("text", "see <|", None, None), ("Image", None, "s3/a.png", 2), ("audio", None, "b.wav", None)]
    df = spark.createDataFrame([(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_turns(df).first()
    assert r["formatted"] == "<|im_start|>user\nsee <\\|<|image|><|audio|><|im_end|>\n"
    assert r["n_attached"] == 640 and [a["part"]["ref"] for a in r["attachments"]] == ["s3/a.png", "b.wav"]


def test_warc_round_trip(spark):
    tricky = "a\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n" * 30
    rows = [(1, "u", "é" * 5000), (2, None, tricky), (3, "a b", tricky), (4, "u", None), (5, "u", ""), (None, "u", "tiny"), (7, "u", "é" * 5000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.new_folder(pages)
    warc.write(pages, folder, segment=600)
    got = {r["page_id"]: r for r in warc.read(spark, folder).collect()}
    assert {r["status"] for r in got.values()} == {"ok"} and len(got) == len(rows)
    for i, _, html in rows:
        assert got[i]["refers_to"] == {3: 2, 7: 1}.get(i)
        assert got[i]["payload"] == (None if i in (3, 7) else (html or "").encode())


@pytest.mark.parametrize("segment", [10**6, 600, *range(240, 280)])
def test_version_line_heads_records_only(segment):
    name = "WARC/1.1"
    end = "x" * (warc.CHUNK - len(name)) + name
    for html in (name, f"a {name}\n", f"{name}\r{name}\r\n\r\n", end, f"{end}{end} more", "y" * 97 + name + "z" * 400):
        row = {"page_id": 1, "url": f"u/{name}", "html": html, "digest": "d", "refers_to": None}
        kept = [r.encode() for r in warc.records(row, "id", "2024-01-01T00:00:00Z", segment)]
        raw = warc.END.encode().join([*kept, b""])
        found = [warc._parse(r) for r in raw.split(warc.VERSION.encode())[1:]]
        assert len(found) == len(kept) and all(r["intact"] for r in found)
        assert warc.unchunked(b"".join(r["block"] for r in found)) == html.encode()


def test_warc_round_trip_of_pages_on_warc(spark):
    rows = [(1, "u/WARC/1.1", "on WARC/1.1"), (2, "v", "x" * (warc.CHUNK - 8) + "WARC/1.1" + "y" * 50), (3, "WARC/1.1", "z" * (warc.SEGMENT // 8) + "WARC/1.1" * 4000), (4, "w", "on WARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = warc.new_folder(pages)
    warc.write(pages, folder)
    got = warc.read(spark, folder).collect()
    assert sorted((r["page_id"], r["status"], r["payload"].decode()) for r in got) == [(i, "ok", html) for i, _, html in rows]


def test_broken_archives():
    assert warc.unchunked(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc") is None
    assert warc.unchunked(b"HTTP/1.1 200 OK\r\n\r\nabc") == b"abc"


@pytest.mark.parametrize(("lost", "status"), [(0, "ok"), (1, "cut"), (4, "cut"), (50, "cut")])
def test_truncated_records_are_cut(spark, tmp_path, lost, status):
    block = "HTTP/1.1 200 OK\r\n\r\n" + "p" * 100
    records = [warc._record([("WARC-Type", "response"), ("WARC-Record-ID", f"<r{k}>"), ("X-Page-ID", k)], block) for k in range(2)]
    for end in (warc.END, ""):
        path = tmp_path / f"{len(end)}.warc"
        path.write_bytes((records[0] + warc.END + records[1][: len(records[1]) - lost] + end).encode())
        got = {r["page_id"]: (r["status"], r["payload"]) for r in warc.read(spark, str(path)).collect()}
        assert got == {0: ("ok", b"p" * 100), 1: (status, b"p" * 100 if lost == 0 else None)}


def test_language(spark):
    rows = [(k, ("the thing is here " if k % 2 else "das ding ist hier ") * (k % 5 + 1), "en" if k % 2 else "de") for k in range(60)]
    df = spark.createDataFrame([*rows, (99, None, "en"), (100, "123", "de")], "doc_id long, text string, lang string")
    model = language.fit(df.where("doc_id < 40"))
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(df, model, ["doc_id"]).collect()}
    assert all(got[i] == lang for i, _, lang in rows) and got[99] == got[100] == "und"


def test_empty_tables(spark):
    none = empty(spark)
    for df in (secrets.scan(none), bpe.encode(none, BYTE), jaccard.similar_groups(none), line_dedup.dedup_lines(none), quality.measure(none), language.predict(none, language.fit(none), ["doc_id"])):
        assert df.count() == 0
    assert decontam.decontaminate(none, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_pipeline_stages_keep_columns(spark):
    words = " ".join(f"word{k} some{k % 7}" for k in range(60))
    rows = [(1, words, "en", "s", len(words)), (2, words, "en", "s", len(words)), (3, "short", "en", "s", 5), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.quality_rules, corpus_pipeline.dedup_lines, corpus_pipeline.near_duplicates):
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert [r["doc_id"] for r in docs.collect()] == [1]


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    a, b, c, d = (" ".join(f"{p}{k}" for k in range(60)) for p in "abcd")
    rows = [(1, a), (1, b), (1, b), (2, f"{a} more"), (3, c), (None, c), (None, d), (None, d), (None, f"{d} more"), (4, b), (None, "x"), (None, None), (5, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    kept = [x for x in got if x[1] not in (d, f"{d} more")]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (3, c), (None, "x"), (None, None), (5, None), (6, "")], key=str)
    assert len(got) == len(kept) + 1
