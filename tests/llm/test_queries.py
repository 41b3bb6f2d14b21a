"""The registered queries on the smallest tables: against DuckDB where SQL can say it, else against the libraries or plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from simquarry.llm import bpe, quality
from simquarry.llm.queries import ORACLE, QUERIES
from tests.compare import duck, run
from tests.llm.test_operators import brute_groups, brute_lines

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(k for k, v in ORACLE.items() if v is not None))
def test_query_is_its_sql(spark, con, name):
    message, ok = run(spark, con, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert ok, message
    assert "EMPTY" not in message


def test_secrets_of_the_base_kinds(spark):
    folder = "/root/testdata/sf0.01"  # the smallest tables with secrets
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    kinds = {
        "assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6),
        "access": (r"(AKIA[A-Z0-9]+)", 20),
        "hex": (r"([0-9a-f]+)", 24),
    }
    some = 0
    for r in QUERIES["op1_secret_scan"](spark, folder).collect():
        text = texts[r["doc_id"]] or ""
        want = [(m.start(), k, kind, m.end()) for k, (kind, (p, least)) in enumerate(kinds.items()) for m in re.finditer(p, text) if len(m[1]) >= least]
        assert [r[f"n_{kind}"] for kind in kinds] == [sum(w[2] == kind for w in want) for kind in kinds]
        assert r["base_sha256"] == sha(",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(want)))
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("random")] == [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(want)]
        some += len(want)
    assert some


def test_byte_level_ids(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in QUERIES["op2_bpe"](spark, SF_DIR).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_ids_in_files(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op7_token_files"](spark, SF_DIR).collect()}
    start = 0
    for doc_id in sorted(texts):
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_languages_of_held_out_documents(spark):
    rows = QUERIES["op8_language_id"](spark, SF_DIR).join(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {r["doc_id"] for r in rows if r["held_out"]} == {r["doc_id"] for r in held}
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held) and all(0 <= r["score"] <= 1 for r in rows)


def test_stages_against_plain_python(spark, texts, con):
    """Each stage on what the one before it kept; the last one's ids are the library's."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    kept = stage["quality_rules"](spark, docs, SF_DIR)
    good = {r[0] for r in con.execute(f"select doc_id from ({ORACLE['op3_quality_rules']}) where kept").fetchall()}
    assert {r["doc_id"] for r in kept.collect()} == good
    rows = {r["doc_id"]: r["text"] for r in stage["near_duplicates"](spark, kept, SF_DIR).select("doc_id", "text").collect()}
    label = brute_groups({i: texts[i] for i in good})
    assert set(rows) == set(label.values()) and all(rows[i] == texts[i] for i in rows)
    clean = {r["doc_id"] for r in stage["benchmark_decontamination"](spark, kept, SF_DIR).collect()}
    hit = {r[0] for r in con.execute(f"select doc_id from ({ORACLE['op5_benchmark_decontamination']}) where contaminated").fetchall()}
    assert clean == good - hit and hit
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = stage["bpe"](spark, kept.limit(30), SF_DIR).collect()
    assert len(last) == 30
    for r in last:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_stage_of_lines(spark):
    """Runs of lines of over 50 words go where they stand again, as brute force has it; the rest stays."""
    line = lambda k, n=20: " ".join(f"p{k}w{j}" for j in range(n))
    rows = [f"first\n{line(1)}\n{line(2)}\n{line(3)}\nend", f"other\n{line(1)}\n{line(2)}\n{line(3)}\nlast", f"{line(4)}\n{line(4)}x", line(5, 60), line(5, 60)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.dedup_lines(spark, docs, "").collect()}
    want = {k: (t, len(t)) for k, t in enumerate(brute_lines(rows, 51)) if t.strip()}
    assert got == want


def test_pipeline(spark, texts):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert 0 < len(rows) < len(texts) and len({r["doc_id"] for r in rows}) == len(rows)


def test_ablations_count_what_only_one_rule_rejects(spark):
    ledger = quality.measure(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    bits = [r["failed"] for r in ledger.select("quality.failed").collect()]
    for r in quality.ablations(ledger, quality.FULL).collect():
        bit = 1 << quality.RULES.index(r["rule"])
        want = (sum(b & bit != 0 for b in bits), sum(b == bit for b in bits), sum(b in (0, bit) for b in bits))
        assert (r["n_failed"], r["n_only"], r["n_kept_without"]) == want


def test_empty_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, __key int, row int")
    for _, stage in corpus_pipeline.STAGES[:3]:
        assert stage(spark, none, SF_DIR).count() == 0
    assert bpe.digests(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert quality.ablations(quality.measure(none), quality.FULL).agg(F.sum("n_failed")).first()[0] in (None, 0)
