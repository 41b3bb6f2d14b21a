"""Language identification by the nearest of several centroids per language.

A text is the vector of its letter n-grams (one to three letters, blanks at
word ends), hashed to ``DIMS`` places, weighted by TF-IDF and normalised.  Each
language has up to ``CENTROIDS`` centroids, found by spherical k-means; the
score is the cosine to the nearest.  A text farther from its language than
nearly all training texts is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simquarry.llm.bpe import slices

DIMS = 4096
CENTROIDS = 4
SAMPLE = 1000  # expected training texts of a language; centroids are fitted on these
MAX_LANGUAGES = 256
QUANTILE = 0.005  # share of training texts that rejection leaves out
ROUNDS = 10
UNKNOWN = "und"

_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint64)


def _letters(text: str) -> np.ndarray | None:
    """Code points of the lowered text with one blank for each run of other characters; None without letters."""
    words = "".join(c if c.isalpha() else " " for c in text) if not text.isascii() else text.translate(_ASCII)
    flat = " ".join(words.lower().split())
    return np.frombuffer(f" {flat} ".encode("utf-32-le"), np.uint32).astype(np.uint64) if flat else None


_ASCII = {c: " " for c in range(128) if not chr(c).isalpha()}


def counts(text: str | None, dims: int = DIMS) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None for null or no letter."""
    x = _letters(text) if text else None
    if x is None:
        return None
    total = np.zeros(dims, np.float32)
    h = x * _ODD[0]
    for n in range(3):
        if n:
            h = h[:-1] * np.uint64(31) + x[n:] * _ODD[n]
        mixed = h ^ (h >> np.uint64(29))
        mixed = (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)
        total += np.bincount((mixed % np.uint64(dims)).astype(np.int64), minlength=dims)
    return total


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(count) * idf
    return v / max(float(np.linalg.norm(v)), 1e-12)


@dataclass
class Model:
    """Size: (languages x CENTROIDS + 1) x DIMS floats."""

    languages: list[str]
    owner: np.ndarray  # language of each centroid
    centroids: np.ndarray
    floor: np.ndarray  # least accepted cosine of each language
    idf: np.ndarray


def _clusters(vectors: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from spread starts: each start is the vector farthest from those before."""
    picked = [int(np.argmax(vectors @ vectors.mean(0)))]
    near = vectors @ vectors[picked[0]]
    while len(picked) < min(k, len(vectors)):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[picked[-1]])
    centres = vectors[picked].copy()
    for _ in range(ROUNDS):
        of = np.argmax(vectors @ centres.T, 1)
        for c in range(len(centres)):
            if (own := vectors[of == c]).size:
                mean = own.mean(0)
                centres[c] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centres


def fit(train: DataFrame, dims: int = DIMS, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    """Learn from rows (doc_id, text, lang) with a language.

    Document frequencies count all rows: each task adds its texts up to one row
    of ``dims`` numbers.  Centroids are fitted on a sample, drawn by a hash of
    doc_id at a rate that expects ``sample`` texts of each language, in one task
    for each language.  More than ``MAX_LANGUAGES`` languages are an error.
    """
    train = train.where("lang is not null and text is not null").select("doc_id", "text", "lang")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(dims, np.int64), 0
        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                if (c := counts(t, dims)) is not None:
                    seen += c > 0
                    n += 1
        at = np.arange(-1, dims)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.concatenate([[n], seen]), pa.int64())], names=["at", "n"])

    rows = train.select("text").mapInArrow(frequencies, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()  # dims + 1 rows
    seen = np.zeros(dims + 1)
    for r in rows:
        seen[r["at"] + 1] = r["n"]
    idf = np.log((1 + seen[0]) / (1 + seen[1:])).astype(np.float32) + 1

    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return Model([], np.zeros(0, int), np.zeros((0, dims), np.float32), np.zeros(0), idf)
    rate = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))))[F.col("lang")]
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def cluster(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = [weighted(c, idf) for t in pdf["text"].sort_values() if (c := counts(t, dims)) is not None]
        if not vectors:
            return pd.DataFrame({"lang": [], "floor": [], "centroid": []})
        found = _clusters(m := np.stack(vectors), centroids)
        floor = float(np.quantile((m @ found.T).max(1), QUANTILE))
        return pd.DataFrame({"lang": key[0], "floor": floor, "centroid": list(found)})

    fitted = train.where(draw < rate).groupBy("lang").applyInPandas(cluster, "lang string, floor double, centroid array<float>").toPandas()  # languages x centroids rows
    fitted = fitted.assign(first=[tuple(c[:8]) for c in fitted["centroid"]]).sort_values(["lang", "first"])
    names = sorted(fitted["lang"].unique())
    floor = fitted.groupby("lang")["floor"].first()
    return Model(names, np.array([names.index(x) for x in fitted["lang"]], int), np.stack(fitted["centroid"].map(np.asarray).tolist()).astype(np.float32) if len(fitted) else np.zeros((0, dims), np.float32), np.array([floor[x] for x in names]), idf)


def predict(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every row, lang_pred, score (cosine, 0 to 1) and rejected.

    A null text or one without letters is ``und`` with score 0, and rejected;
    so is everything under a model without languages.  Ties go to the first
    language in alphabetical order.
    """
    schema = docs.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, "__text"):
            vectors = [counts(t, len(m.idf)) for t in batch.column("__text").to_pylist()]
            at = [i for i, v in enumerate(vectors) if v is not None] if m.languages else []
            name, score, rejected = [UNKNOWN] * len(vectors), np.zeros(len(vectors)), [True] * len(vectors)
            for a in range(0, len(at), 512):
                some = at[a : a + 512]
                cosine = np.stack([weighted(vectors[i], m.idf) for i in some]) @ m.centroids.T
                for i, best, value in zip(some, cosine.argmax(1), cosine.max(1), strict=True):
                    lang = m.owner[best]
                    name[i], score[i], rejected[i] = m.languages[lang], min(1.0, max(0.0, float(value))), bool(value < m.floor[lang])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=[*keep, "lang_pred", "score", "rejected"])

    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether the document is in the fold that is not learned from; null ids are."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(folds)) == fold, F.lit(True))
