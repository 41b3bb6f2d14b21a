"""Byte-level BPE by a segment tree over byte positions.

Leaf i of a word's tree holds the rank of joining the piece that begins at byte
i with the piece behind it, and i; a node holds the least of its two children.
The root is therefore the leftmost pair of least rank.  A merge changes three
leaves, those of the piece, of the piece before it and of the one swallowed, so
it costs a logarithm of the word's length: a word of n bytes takes O(n log n),
also where a text is one word.

Documents stay where they are: each task encodes the distinct words of its own
batches once and remembers a bounded number of them.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.llm.bpe import id_lists, packed, slices

# Up to here all versions of Unicode agree on what is a letter, number or blank.
FAMILIAR = 0x250
PLAIN = re.compile(r"[\x00-ɏ]*")
BLANK = r"\t-\r \x85\xa0"
# A run without blanks and the space before it, or blanks: no match of the
# pattern goes beyond one of these.
CHUNK = re.compile(rf" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")

MAX_KNOWN = 600_000  # chunks that a worker remembers before it starts anew
MAX_BYTES = 48 << 20  # and their bytes
NONE = 1 << 62  # above the rank and place of any pair
WIDEST = 64  # bytes of a word that is merged together with others
LEAVES = 1 << 19  # leaves that are merged together


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their ids, from lines of base64 and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the pair of least rank, the leftmost of these, is joined until none can be."""
    n = len(word)
    width = 1 << (n - 1).bit_length()
    before = [*range(-1, n)]
    after = [*range(1, n + 1), n]  # where the next piece begins; n at the end

    def key(at: int) -> int:
        """Rank and place of the pair that begins at ``at``."""
        second = after[at]
        rank = ranks.get(word[at : after[second]]) if second < n else None
        return NONE if rank is None else rank * width + at

    tree = [NONE] * (2 * width)
    for at in range(n - 1):
        tree[width + at] = key(at)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(at: int, value: int) -> None:
        node = width + at
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                return
            tree[node] = least

    while tree[1] < NONE:
        at = tree[1] % width
        gone = after[at]
        after[at] = behind = after[gone]
        before[behind] = at
        put(gone, NONE)
        put(at, key(at))
        if at:
            put(before[at], key(before[at]))
    ids, at = [], 0
    while at < n:
        ids.append(ranks[word[at : after[at]]])
        at = after[at]
    return ids


class Forest:
    """The trees of many short words of one width side by side, merged step by step together.

    The same tree as in ``merge``, a row for each word: a step takes the root of
    every row that still has a pair.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = np.array(sorted(pairs), np.int64)
        self.rank = np.array([pairs[p] for p in self.pairs.tolist()], np.int64)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def _keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        """Rank and place of pairs of ids."""
        pair = left << 32 | right
        found = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[found] == pair, self.rank[found] * width + at, NONE)

    def merge(self, words: list[bytes], width: int) -> list[bytes]:
        """Packed ids of ``words`` of ``width`` bytes at most (a power of two)."""
        n = len(words)
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(n, width)
        length = np.fromiter(map(len, words), np.int64, n)[:, None]
        place = np.arange(width)
        # The column ``width`` stands for what is beyond either end.
        token = np.zeros((n, width + 1), np.int64)
        token[:, :width] = self.single[raw]
        live = place < length
        after = np.full((n, width + 1), width, np.int64)
        after[:, :width] = np.where(place + 1 < length, place + 1, width)
        before = np.full((n, width + 1), width, np.int64)
        before[:, 1:width] = place[:-1]
        tree = np.full((n, 2 * width), NONE, np.int64)
        rows, at = np.nonzero(place + 1 < length)
        tree[rows, width + at] = self._keys(token[rows, at], token[rows, at + 1], at, width)
        for node in range(width - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
            node = width + at
            tree[rows, node] = value
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.arange(n)
        while len(rows := rows[tree[rows, 1] < NONE]):
            rank, at = np.divmod(tree[rows, 1], width)
            gone = after[rows, at]
            behind = after[rows, gone]
            token[rows, at] = rank
            live[rows, gone] = False
            after[rows, at] = behind
            before[rows, behind] = at
            put(rows, gone, NONE)
            put(rows, at, np.where(behind < width, self._keys(rank, token[rows, behind], at, width), NONE))
            first = before[rows, at]
            has = first < width
            put(rows[has], first[has], self._keys(token[rows[has], first[has]], rank[has], first[has], width))
        ids = token[:, :width][live].astype("<u4").tobytes()
        ends = (4 * np.cumsum(live.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Shape(dict):
    """For ``str.translate``: characters from ``FAMILIAR`` on to one of the same class below it.

    The classes are asked of the library itself, whose Unicode version decides:
    a character is a letter if it forms one word with a letter before it.
    """

    STANDS = {"a": "é", "1": "²", "!": "¤"}

    def __init__(self, pattern: str) -> None:
        super().__init__()
        self.ranks = {bytes([b]): b for b in range(256)}
        for first in self.STANDS:
            self.ranks |= {first.encode() + bytes([b]): len(self.ranks) + b for b in range(256)}
        self.probe = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})

    def __missing__(self, code: int) -> int | str:
        self[code] = found = code if code < FAMILIAR else self._class(chr(code))
        return found

    def _class(self, c: str) -> str:
        for first, stand in self.STANDS.items():
            if self.probe.encode_ordinary(first + c)[0] == self.ranks[first.encode() + c.encode()[:1]]:
                return stand
        return "\xa0"


class Encoder:
    """Whole texts to ids (four bytes each, little-endian) and back."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks = read_ranks(path)
        self.forest = Forest(self.ranks)
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.bytes_of}
        self.matches = regex.compile(pattern).finditer
        self.find = regex.compile(pattern).findall
        self.shape = Shape(pattern)
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.size = 0

    def _split(self, text: str) -> list[str]:
        if PLAIN.fullmatch(text):
            return CHUNK.findall(text)
        return [text[m.start() : m.end()] for m in CHUNK.finditer(text.translate(self.shape))]

    def _learn_words(self, words: list[str]) -> None:
        """A word that is a token is that token; the others go through their trees."""
        by_width: dict[int, list[str]] = {}
        for word in words:
            raw = word.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.words[word] = packed([whole])
            elif len(raw) > WIDEST:
                self.words[word] = packed(merge(raw, self.ranks))
            else:
                by_width.setdefault(max(4, 1 << (len(raw) - 1).bit_length()), []).append(word)
        for width, same in by_width.items():
            step = LEAVES // width
            for at in range(0, len(same), step):
                part = same[at : at + step]
                self.words.update(zip(part, self.forest.merge([w.encode() for w in part], width), strict=True))

    def _learn(self, chunks: set[str]) -> None:
        """Remember the ids of ``chunks``."""
        new = [c for c in chunks if c not in self.chunks]
        if len(self.chunks) + len(new) > MAX_KNOWN or self.size > MAX_BYTES:
            self.words, self.chunks, self.size = {}, {}, 0
            new = list(chunks)
        split = self._words_of(new)
        self._learn_words(list({w for words in split.values() for w in words if w not in self.words}))
        known = self.words
        for chunk, words in split.items():
            self.chunks[chunk] = ids = known[words[0]] if len(words) == 1 else b"".join([known[w] for w in words])
            self.size += 2 * len(chunk) + len(ids)

    def _words_of(self, chunks: list[str]) -> dict[str, list[str]]:
        """The matches in each chunk; those of plain chunks by one search, as a line break is a match of its own before a word."""
        plain = [c for c in chunks if not c.isspace() and PLAIN.fullmatch(c)]
        split = {c: [c[m.start() : m.end()] for m in self.matches(c.translate(self.shape))] for c in set(chunks).difference(plain)}
        own: list[str] = []
        found = iter(plain)
        for word in self.find("\n".join([*plain, ""])):
            if word == "\n":
                split[next(found)] = own
                own = []
            else:
                own.append(word)
        return split

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        split = list(map(self._split, texts))
        self._learn(set(chain.from_iterable(split)))
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of their decimal list and of the bytes they stand for."""
        own = np.frombuffer(ids, "<u4").tolist()
        listed = " ".join(map(self.decimal.__getitem__, own))
        return len(own), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(self.decode(own)).hexdigest()


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of this process; what it has learned serves the next task too."""
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (doc_id) of ``docs`` and ``ids`` (array of int) of each whole ``text``.

    ``path`` names the file of ranks on every executor, ``pattern`` splits texts
    into words.  A null or empty text has no ids; no string is special.  Each row
    is on its own, so repeated rows give repeated rows, and other columns are not
    looked at.
    """
    keep = keep or ["doc_id"]
    asked = docs.select(*keep, F.col("text").alias("__text"))
    schema = docs.select(*keep, F.lit(None).cast("array<int>").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches, "__text"):
            ids = id_lists(own.encode([t or "" for t in batch.column("__text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], names=[*keep, "ids"])

    return asked.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` and ``bytes`` of rows with ``ids``; null ids are no bytes.

    Ids cut anywhere still give their bytes, which need not be whole characters.
    """
    keep = keep or ["doc_id"]
    schema = encoded.select(*keep, F.lit(None).cast("binary").alias("bytes")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches, "ids"):
            raw = pa.array([own.decode(x or []) for x in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), raw], names=[*keep, "bytes"])

    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by a space) and decoded_sha256 of each row, in one pass."""
    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in slices(batches, "text"):
            rows = list(map(own.digests, own.encode([t or "" for t in batch.column("text").to_pylist()])))
            counts, ids, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
