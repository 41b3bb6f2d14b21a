"""Byte-pair encoding by walking a trie of distinct words.

The last token of the encoding of a prefix is the one token that ends there and
may follow the last token of what stands before it; so the states of a word are
those of its prefix and one more.  The distinct words of a batch, in order, are
a trie walked depth first: what two neighbours share is a path already on the
stack, and is not computed again.  The tokens that end at a prefix come from an
automaton of all tokens (Aho-Corasick), whose state stands on the stack too.  An
encoding is read off the states from the end of the word back to its start.

Documents stay where they are: each task encodes the words of its own batches.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Fixed value: the split of byte-level encodings, with the white space below U+0250 written out.
SPACE = r"\t-\r \x85\xa0"
CHUNK = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
# Characters on whose classes all versions of Unicode agree; texts with others
# are split by the tokenizer itself.
PLAIN = re.compile(r"[\x00-\u024f]*")

MAX_WORDS = 200_000  # words and chunks that a worker remembers; it forgets those not met for longest
MAX_BYTES = 16 << 20  # and the size of these and their ids
MAX_PAIRS = 250_000  # pairs of tokens that it remembers before it starts anew
BATCH = 1 << 20  # bytes of text that are encoded at once


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Vocabulary:
    """A byte-level BPE vocabulary: ranks of merges, and the automaton of its tokens."""

    path: str
    ranks: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)
    special: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        with open(self.path, encoding="utf-8") as f:
            model = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        every = {raw(s): i for s, i in model["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks.setdefault((every[a], every[b]), (rank, every[a + b]))
        self.bytes_of = {i: s for s, i in every.items()}
        self.single = [every[bytes([b])] for b in range(256)]
        self._automaton(self._parts())
        self.follows: dict[int, bool] = {}
        self.tokenizer = Tokenizer.from_file(self.path)
        self.text_of = self.bytes_of | {i: s.encode() for s, i in self.special.items()}

    def merge(self, word: bytes) -> list[int]:
        """The definition: merge the pair of least rank, the leftmost first."""
        ids = [self.single[b] for b in word]
        while len(ids) > 1:
            best = min((self.ranks[p] + (k,) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.ranks), key=lambda x: (x[0], x[2]), default=None)
            if best is None:
                break
            ids[best[2] : best[2] + 2] = [best[1]]
        return ids

    def _parts(self) -> list[int]:
        """Find the tokens that merging their own bytes yields, as only these can occur, and their last merges.

        Where each merge comes after all that yield its parts, merges are made in
        the order of their ranks, and two parts tell which merge of them is next.
        """
        size = max(self.bytes_of) + 1
        latest = [-1] * size  # rank of the last merge that yields a token
        for rank, joined in self.ranks.values():
            latest[joined] = rank
        self.ordered = all(max(latest[a], latest[b]) < rank for (a, b), (rank, _) in self.ranks.items())
        self.made = [-1] * size  # rank of a token's last merge
        self.left = [-1] * size  # and its two parts
        self.right = [-1] * size
        if not self.ordered:
            return [i for i, s in self.bytes_of.items() if self.merge(s) == [i]]
        found = set(self.single)
        for (a, b), (rank, joined) in self.ranks.items():
            if joined not in found and a in found and b in found and not self._crossed(a, b):
                found.add(joined)
                self.made[joined], self.left[joined], self.right[joined] = rank, a, b
        return list(found)

    def _crossed(self, a: int, b: int) -> bool:
        """Whether some merge joins what lies on both sides of the border before ``a`` and ``b`` are there.

        Their merges are taken back, the last first.  Of merges of one rank that on the left came first.
        """
        ranks, made, left, right = self.ranks, self.made, self.left, self.right
        ra, rb = made[a], made[b]
        while ra >= 0 or rb >= 0:
            if ra > rb:
                limit = ra
                a = right[a]
                ra = made[a]
            else:
                limit = rb + 1
                b = left[b]
                rb = made[b]
            over = ranks.get((a, b))
            if over is not None and over[0] < limit:
                return True
        return False

    def _automaton(self, tokens: list[int]) -> None:
        """The trie of ``tokens``, with the state of the longest suffix that is in it and the tokens that end, longest first."""
        self.step: dict[int, int] = {}  # state and byte to state
        self.size_of = [0] * (max(self.bytes_of) + 1)
        token, edge, depth = array("q", [-1]), array("q", [0]), array("q", [0])
        for i in sorted(tokens, key=self.bytes_of.__getitem__):
            at = 0
            for k, byte in enumerate(self.bytes_of[i], 1):
                to = self.step.setdefault(at << 8 | byte, len(token))
                if to == len(token):
                    token.append(-1)
                    edge.append(at << 8 | byte)
                    depth.append(k)
                at = to
            token[at] = i
            self.size_of[i] = depth[at]
        self.shorter = array("q", [0]) * len(token)
        self.ends: list[tuple[int, ...]] = [()] * len(token)
        for at in np.argsort(depth, kind="stable")[1:].tolist():
            up, byte = edge[at] >> 8, edge[at] & 255
            if up:
                up = self.shorter[up]
                while (to := self.step.get(up << 8 | byte)) is None:
                    up = self.shorter[up]
                self.shorter[at] = to
            rest = self.ends[self.shorter[at]]
            self.ends[at] = rest if token[at] < 0 else (token[at], *rest)

    def may_follow(self, a: int, b: int) -> bool:
        pair = a << 32 | b
        known = self.follows.get(pair)
        if known is None:
            if len(self.follows) >= MAX_PAIRS:
                self.follows.clear()
            known = (a, b) not in self.ranks and not self._crossed(a, b) if self.ordered else self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            self.follows[pair] = known
        return known


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class WordTrie:
    """Encodings of words, computed along the trie that they form."""

    def __init__(self, voc: Vocabulary) -> None:
        self.voc = voc
        self.known: dict[str, bytes] = {}
        self.size = 0

    def use(self, words: set[str]) -> set[str]:
        """Those of ``words`` that are not known.  The others become the last to be forgotten."""
        known = self.known
        new = words - known.keys()
        for w in words - new:
            known[w] = known.pop(w)
        return new

    def forget(self, stay: int, room: int) -> None:
        """Make room for so many words.  A worker outlives its tasks: what is in use stays, the last ``stay``."""
        known = self.known
        over = len(known) + room - MAX_WORDS
        if over <= 0 and self.size <= MAX_BYTES:
            return
        for w in list(islice(known, max(0, len(known) - stay))):
            if over <= 0 and self.size <= MAX_BYTES:
                break
            self.size -= len(w) + len(known.pop(w))
            over -= 1

    def keep(self, word: str, ids: bytes) -> None:
        self.known[word] = ids
        self.size += len(word) + len(ids)

    def add(self, new: set[str]) -> None:
        """Learn the encodings of words that are not known."""
        last: list[int] = []  # last token of each prefix, from length 1
        span: list[int] = []  # its number of bytes
        states: list[int] = []  # and the state of the automaton
        before = b""
        for word in sorted(new):  # as their bytes would be
            raw = word.encode()
            keep = 0
            for x, y in zip(before, raw, strict=False):
                if x != y:
                    break
                keep += 1
            del last[keep:], span[keep:], states[keep:]
            self._extend(raw, last, span, states)
            self.keep(word, self._read(last, span))
            before = raw

    def _extend(self, raw: bytes, last: list[int], span: list[int], states: list[int]) -> None:
        voc = self.voc
        step, shorter, ends, size_of, follows = voc.step.get, voc.shorter, voc.ends, voc.size_of, voc.follows.get
        at = states[-1] if states else 0
        for end in range(len(last), len(raw)):
            byte = raw[end]
            while (to := step(at << 8 | byte)) is None:
                at = shorter[at]
            at = to
            for token in ends[at]:
                size = size_of[token]
                if size <= end:
                    before = last[end - size]
                    fits = follows(before << 32 | token)
                    if not (voc.may_follow(before, token) if fits is None else fits):
                        continue
                last.append(token)
                span.append(size)
                states.append(at)
                break

    @staticmethod
    def _read(last: list[int], span: list[int]) -> bytes:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= span[at - 1]
        return packed(out[::-1])


class Encoder:
    """Whole texts to ids and back.

    Ids are bytes, four for each, little-endian.  Texts are taken in chunks (a
    run without white space with the blank before it, or white space), which
    the vocabulary's split never joins; the words of a chunk go to the trie.
    """

    def __init__(self, path: str) -> None:
        self.voc = vocabulary(path)
        self.trie = WordTrie(self.voc)
        self.words = regex.compile(SPLIT).findall
        names = sorted(self.voc.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.letters = byte_letters()
        # A word is split into itself, so words and chunks share one memory.
        self.known = self.trie.known

    def _learn(self, chunks: set[str]) -> None:
        new = self.trie.use(chunks)
        # Letters with or without a blank before them are one word.
        split = {c: self.words(c) for c in new if not (c.isalpha() or (c[0] == " " and c[1:].isalpha()))}
        words = {w for words in split.values() for w in words} | (new - split.keys())
        ask = self.trie.use(words)
        self.trie.forget(len(chunks) - len(new) + len(words) - len(ask), len(new | ask))
        self.trie.add(ask)
        find = self.known.__getitem__
        for c, words in split.items():
            if len(words) > 1:
                self.trie.keep(c, b"".join(map(find, words)))

    def _whole(self, text: str) -> bytes:
        """For texts beyond ``PLAIN``: the tokenizer splits, the trie encodes."""
        raw = (bytes(self.letters[c] for c in w) for w, _ in self.voc.tokenizer.pre_tokenizer.pre_tokenize_str(text))
        words = [w.decode() for w in raw]
        self.trie.add(self.trie.use(set(words)))
        return b"".join(map(self.trie.known.__getitem__, words))

    def encode_batch(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text.  The words of all texts go through the trie together."""
        split = []
        for text in texts:
            pieces = self.special.split(text) if self.special else [text]
            split.append([(p, CHUNK.findall(p) if p not in self.voc.special and PLAIN.fullmatch(p) else None) for p in pieces])
        self._learn({c for pieces in split for _, chunks in pieces for c in chunks or ()})
        find = self.known.__getitem__
        for pieces in split:
            yield b"".join(
                b"".join(map(find, chunks)) if chunks is not None else packed([self.voc.special[p]]) if p in self.voc.special else self._whole(p) for p, chunks in pieces
            )

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.voc.text_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this process; what it has learned serves the next task too."""
    return Encoder(path)


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, "<u4").tobytes()


def id_lists(ids: list[bytes]) -> pa.ListArray:
    """Packed ids as an Arrow column, without an object for each id."""
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), np.int32)))


def slices(batches: Iterator[pa.RecordBatch], texts: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of about ``most`` bytes of text, at least a row each."""
    for batch in batches:
        size = batch.column(texts).get_total_buffer_size() if batch.num_rows else 0
        step = max(1, batch.num_rows * most // max(size, 1))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def encode(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id) of ``docs`` and ``ids`` (array of int) of each whole text.

    A null or empty text has no ids.  Strings of special tokens in a text are
    those tokens.  ``path`` names the vocabulary file on every executor.
    """
    keep = keep or ["doc_id"]
    asked = docs.select(*keep, F.col("text").alias("__text"))
    schema = docs.select(*keep, F.lit(None).cast("array<int>").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__text", BATCH):
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            ids = id_lists(list(encoder(path).encode_batch(texts)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], names=[*keep, "ids"])

    return asked.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``text`` of rows with ``ids``; null ids are an empty text."""
    keep = keep or ["doc_id"]
    schema = encoded.select(*keep, F.lit(None).cast("string").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            texts = pa.array([encoder(path).decode(packed(x or [])) for x in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), texts], names=[*keep, "text"])

    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (little-endian, 32 bits) and of the text decoded from them.

    One pass: the ids of a batch are encoded, decoded and digested where they are.
    """
    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in slices(batches, "text", BATCH):
            counts, ids_hex, texts_hex = [], [], []
            for ids in own.encode_batch([t or "" for t in batch.column("text").to_pylist()]):
                counts.append(len(ids) // 4)
                ids_hex.append(hashlib.sha256(ids).hexdigest())
                texts_hex.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(texts_hex, pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
