"""Similarity join of texts by the Jaccard index of their word shingles.

Equal sets are one node from the start.  A node's least shingles, rarest first,
make blocks: two sets similar enough share one of them.  In a block the sets
form a signature tree, whose nodes carry the OR of their sets' bitmaps and the
range of their sizes.  Two subtrees are compared only if the largest overlap
that these allow is large enough; what remains is verified on the full sets.

Links serve to find groups, so a block first gives a spanning forest of its
possible links (round one), and then all possible links between sets that the
verified ones have not joined (round two).  Nothing similar enough is lost, and
a group of n sets costs about n pairs, not n squared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simquarry.llm.bpe import slices
from simquarry.llm.components import components
from simquarry.session import broadcast_if_small, freeze

WORDS = 5
PERCENT = 80
LEAF, FAN = 16, 8
BLOCK = 1024  # sets of a block in one task at once
LONGS = 8  # of 64 bits in a bitmap
FREQUENT = 1000  # a shingle in more than 1/FREQUENT of the sets is frequent
PIECE = 1 << 19  # bytes of text that are split and hashed at once
LONG_WORD = 64  # bytes; words up to this are hashed side by side
MAX_FREQUENT = 500_000  # rows sent to all tasks at most; it orders shingles only

BITS = [f"bits{k}" for k in range(LONGS)]
_MUL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k of eight bytes
_LOWERED = bytes.maketrans(b"\t\n\v\f\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"     abcdefghijklmnopqrstuvwxyz")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts of about ``PIECE`` bytes: the first one's number, all their bytes, and the bounds of each; null is empty."""
    texts = texts.cast(pa.binary()).fill_null(b"")
    _, ends, data = texts.buffers()
    bounds = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    cuts = np.searchsorted(bounds[:-1], np.arange(bounds[0], bounds[-1] + 1, PIECE))
    cuts = np.unique(np.r_[0, cuts, len(texts)]).tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        own = bounds[a : b + 1]
        yield a, data.slice(own[0], own[-1] - own[0]).to_pybytes() if own[-1] > own[0] else b"", own - own[0]


def _word_hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word, eight bytes at a time; ``data`` has eight bytes more after the last."""
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    n = end - start
    h = _mixed((eights[start] & _LOW[np.minimum(n, 8)]) + n.astype(np.uint64) * _MUL[0])
    for k in range(8, LONG_WORD, 8):
        more = np.flatnonzero(n > k)
        if not len(more):
            break
        h[more] = _mixed((eights[start[more] + k] & _LOW[np.minimum(n[more] - k, 8)]) + h[more] * _MUL[1])
    for i in np.flatnonzero(n > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]])
    return h


def shingle_sets(data: bytes, bounds: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of whole texts, one text after the other, and the bounds of each.

    Text i is ``data[bounds[i] : bounds[i + 1]]``.  Words stand between blanks,
    A-Z lowered.  Fewer than ``size`` words are one shingle; none make the empty
    set.  The texts are worked on side by side: nothing is done word by word
    but for words of more than ``LONG_WORD`` bytes.
    """
    data = data.translate(_LOWERED) + b" " * 8
    letter = np.frombuffer(data, np.uint8) != 32
    first, last = letter.copy(), letter.copy()
    np.greater(letter[1:], letter[:-1], out=first[1:])
    np.greater(letter[:-1], letter[1:], out=last[:-1])
    # A word ends with its text; the blanks at the end stand in for what is outside.
    first[bounds[:-1]] = letter[bounds[:-1]]
    last[bounds[1:] - 1] = letter[bounds[1:] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = np.searchsorted(start, bounds)
    h, n = _word_hashes(data, start, end), np.diff(words)

    found = np.zeros(len(h), np.uint64)
    windows = max(0, len(h) - size + 1)
    for k in range(size):
        found[:windows] = found[:windows] * np.uint64(31) + h[k : windows + k] * _MUL[k % len(_MUL)]
    found = _mixed(found)
    inside = np.ones(len(h), bool)
    for k in range(1, size):
        inside[words[1:][n >= k] - k] = False
    for i in np.flatnonzero((n > 0) & (n < size)).tolist():
        a, b = words[i], words[i + 1]
        found[a] = xxhash.xxh3_64_intdigest(b" ".join(data[x:y] for x, y in zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)), seed=int(n[i]))
        inside[a] = True
    found = found[inside]
    at = np.r_[0, np.cumsum(np.where(n < size, n > 0, n - size + 1))]
    for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
        found[a:b].sort()
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    new[at[:-1][n > 0]] = True
    return found[new], np.r_[0, np.cumsum(new)][at]


def _keys(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The node of each set: a hash of its hashes, as a signed 64-bit number."""
    bounds, digest = at.tolist(), xxhash.xxh3_64_intdigest
    return np.array([digest(s[a:b].tobytes(), seed=b - a) for a, b in zip(bounds, bounds[1:], strict=False)], np.uint64).view(np.int64)


def _bitmaps(s: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of ``LONGS`` numbers for each set."""
    n = np.diff(at)
    bits = np.zeros((len(n), 64 * LONGS), bool)
    bits[np.repeat(np.arange(len(n)), n), (s >> np.uint64(48)) % np.uint64(64 * LONGS)] = True
    return np.packbits(bits, axis=1).view(np.int64)


def _wide_bitmaps(s: np.ndarray, at: np.ndarray) -> pa.Array:
    """A bitmap for each set with a power of two of bits, at least one for each shingle; null for the empty set."""
    n = np.diff(at)
    width = np.where(n > 0, np.maximum(512, 1 << np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64)), 0)
    ends = np.r_[0, np.cumsum(width)]
    bits = np.zeros(ends[-1], bool)
    bits[np.repeat(ends[:-1], n) + (s & np.repeat((width - 1).astype(np.uint64), n)).astype(np.int64)] = True
    valid = np.packbits(n > 0, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [pa.py_buffer(x) for x in (valid, (ends // 8).astype(np.int32), np.packbits(bits, bitorder="little"))])


def _differing(x: bytes, y: bytes) -> int:
    """Bits in which two wide bitmaps differ at least; the wider is folded to the width of the other."""
    x, y = sorted((x, y), key=len)
    narrow = np.frombuffer(x, np.uint64)
    folded = np.bitwise_or.reduce(np.frombuffer(y, np.uint64).reshape(-1, len(narrow)), axis=0)
    return int(np.bitwise_count(narrow ^ folded).sum())


def _often(sets: dict[int, np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in ``least`` sets or more, and in how many; ``sets`` is emptied.

    The shingles of a batch are held once, and counted where a run begins.
    """
    token = np.concatenate(list(sets.values()))
    sets.clear()
    token.sort()
    if len(token) < least:
        return token[:0], np.empty(0, np.int64)
    begins = token[: len(token) - least + 1] == token[least - 1 :]
    begins[1:] &= token[1 : len(begins)] != token[: len(begins) - 1]
    at = np.flatnonzero(begins)
    return token[at], np.searchsorted(token, token[at], "right") - at


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """For each row: doc_id, node, n and bitmaps; and in rows of their own the shingles frequent in a batch (token, seen)."""
    longs = ["doc_id", "node", "n", *BITS, "token", "seen"]
    schema = ", ".join(f"{c} long" for c in longs) + ", wide binary"
    arrow = pa.schema([*((c, pa.int64()) for c in longs), ("wide", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 16 << 20):
            once: dict[int, np.ndarray] = {}
            for first, data, bounds in _pieces(batch.column("text")):
                s, at = shingle_sets(data, bounds, size)
                n, node, bits = np.diff(at), _keys(s, at), _bitmaps(s, at)
                none = pa.nulls(len(n), pa.int64())
                ids = batch.column("doc_id").slice(first, len(n))
                yield pa.RecordBatch.from_arrays([ids, pa.array(node, mask=n == 0), pa.array(n), *(pa.array(bits[:, k]) for k in range(LONGS)), none, none, _wide_bitmaps(s, at)], schema=arrow)
                once |= {node[i]: s[at[i] : at[i + 1]] for i in np.flatnonzero(n).tolist()}
            if once:
                token, seen = _often(once, max(2, len(once) // FREQUENT))
                none = pa.nulls(len(token), pa.int64())
                yield pa.RecordBatch.from_arrays([*[none] * (3 + LONGS), pa.array(_signed(token)), pa.array(seen), pa.nulls(len(none), pa.binary())], schema=arrow)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def _prefixes(docs: DataFrame, size: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(token, node): the least shingles of each set, of which two sets similar enough share one.

    Shingles go by hash, frequent ones after all others by how frequent they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    arrow = pa.schema([("token", pa.int64()), ("node", pa.int64())])

    def least(s: np.ndarray, at: np.ndarray, tokens: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen shingles of all sets, and for each the number of its set."""
        n = np.diff(at)
        take = n - (percent * n + 99) // 100 + (n > 0)
        own = np.repeat(np.arange(len(n)), n)
        where = np.minimum(np.searchsorted(tokens, s), max(len(tokens) - 1, 0))
        is_rare = tokens[where] != s if len(tokens) else np.ones(len(s), bool)
        before = np.r_[0, np.cumsum(is_rare)]
        rare = np.diff(before[at])
        chosen = is_rare & (before[1:] - before[at[:-1]][own] <= take[own])
        for i in np.flatnonzero(rare < take).tolist():
            often = at[i] + np.flatnonzero(~is_rare[at[i] : at[i + 1]])
            chosen[often[np.lexsort((s[often], seen[where[often]]))][: take[i] - rare[i]]] = True
        return s[chosen], own[chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen = shared.value
        for batch in slices(batches, "text", 16 << 20):
            known: set[int] = set()
            for _, data, bounds in _pieces(batch.column("text")):
                s, at = shingle_sets(data, bounds, size)
                node = _keys(s, at)
                token, own = least(s, at, tokens, seen)
                # Of equal sets of a batch, the first.
                once = np.zeros(len(node), bool)
                once[[i for i, key in enumerate(node.tolist()) if not (key in known or known.add(key))]] = True
                yield pa.RecordBatch.from_arrays([pa.array(_signed(token[once[own]])), pa.array(node[own[once[own]]])], schema=arrow)

    return docs.select("text").mapInArrow(run, "token long, node long")


def _blocks(prefixes: DataFrame) -> DataFrame:
    """(block, chunk, node) for every shingle of two sets or more.

    A block of up to ``BLOCK`` sets is named by its sets, so that the many
    shingles that the same sets share make one block (chunk -1).  Larger ones
    are named by the shingle and cut into chunks, in an order of nodes that
    differs from shingle to shingle.
    """
    ordered = prefixes.repartition("token").sortWithinPartitions("token", F.xxhash64("token", "node"), "node")
    names = ["block", "chunk", "node"]

    def rows(block: np.ndarray, chunk: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block.astype(np.int64)), pa.array(chunk.astype(np.int64)), pa.array(node)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = (np.empty(0, np.int64), np.empty(0, np.int64))
        chunk = 0  # chunks already written of the token carried on
        known: set[int] = set()
        for batch in _ended(batches):
            token, node = carried
            if batch is not None:
                token = np.concatenate([token, batch.column("token").to_numpy()])
                node = np.concatenate([node, batch.column("node").to_numpy()])
            if not len(token):
                continue
            new = np.ones(len(token), bool)
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            token, node = token[new], node[new]
            start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            size = np.diff(np.r_[start, len(token)])
            ended = np.arange(len(start)) < len(start) - (batch is not None)
            large = size > BLOCK
            large[0] |= chunk > 0

            at = np.flatnonzero(ended & ~large & (size >= 2))
            digest = np.add.reduceat(_mixed(node.view(np.uint64)), start) ^ size.astype(np.uint64)
            at = at[np.unique(digest[at], return_index=True)[1]]
            at = np.array([k for k in at if int(digest[k]) not in known], int)
            if len(known) > 1_000_000:
                known.clear()
            known.update(map(int, digest[at]))
            if len(at):
                before = np.cumsum(size[at]) - size[at]
                take = np.arange(size[at].sum()) + np.repeat(start[at] - before, size[at])
                yield rows(_signed(np.repeat(digest[at], size[at])), np.full(len(take), -1), node[take])

            for k in np.flatnonzero(ended & large):
                own = slice(start[k], start[k] + size[k])
                yield rows(token[own], (chunk if k == 0 else 0) + np.arange(size[k]) // BLOCK, node[own])
            # The last token may go on: up to a chunk of it waits for the next batch.
            first, left = (chunk if len(start) == 1 else 0), start[-1]
            if batch is not None:
                whole = (size[-1] - 1) // BLOCK * BLOCK
                if whole:
                    yield rows(token[left : left + whole], first + np.arange(whole) // BLOCK, node[left : left + whole])
                carried, chunk = (token[left + whole :], node[left + whole :]), first + whole // BLOCK

    return ordered.mapInArrow(run, "block long, chunk long, node long").dropDuplicates(["block", "chunk", "node"])


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


class SignatureTree:
    """A tree over sets ordered by size and bitmap, kept as one array for each level.

    A node has the OR of the bitmaps below it, the range of sizes, and the most
    shingles that a set below has beyond its bits.
    """

    def __init__(self, n: np.ndarray, bits: np.ndarray) -> None:
        self.n, self.bits = n, bits
        spare = n - np.bitwise_count(bits).sum(1, dtype=np.int64)
        level = (bits, n, n, spare)
        self.levels = []
        width = LEAF
        while True:
            at = np.arange(0, len(level[1]), width)
            level = (np.bitwise_or.reduceat(level[0], at), np.minimum.reduceat(level[1], at), np.maximum.reduceat(level[2], at), np.maximum.reduceat(level[3], at))
            self.levels.append(level)
            width = FAN
            if len(at) == 1:
                break

    @staticmethod
    def _possible(a: tuple, b: tuple, percent: int) -> np.ndarray:
        """Whether nodes a and b, pairwise, may hold sets similar enough."""
        common = np.bitwise_count(a[0] & b[0]).sum(-1, dtype=np.int64)
        most = np.minimum(np.minimum(a[2], b[2]), np.minimum(a[3], b[3]) + common)
        fits = (100 + percent) * most >= percent * (a[1] + b[1])
        return fits & (100 * a[2] >= percent * b[1]) & (100 * b[2] >= percent * a[1])

    def leaf_pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of leaves that remain after pruning from the root."""
        i = j = np.zeros(1, int)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            keep = self._possible(tuple(x[i] for x in level), tuple(x[j] for x in level), percent)
            i, j = i[keep], j[keep]
            if depth:
                below = len(self.levels[depth - 1][1])
                step = np.arange(FAN)
                ci = (i[:, None, None] * FAN + step[None, :, None] + 0 * step).ravel()
                cj = (j[:, None, None] * FAN + step[None, None, :] + 0 * step[:, None]).ravel()
                ok = (ci <= cj) & (ci < below) & (cj < below)
                i, j = ci[ok], cj[ok]
        return i, j

    def possible(self, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of sets (x < y) in these pairs of leaves that may be similar enough."""
        step = np.arange(LEAF)
        x = (i[:, None, None] * LEAF + step[None, :, None] + 0 * step).ravel()
        y = (j[:, None, None] * LEAF + step[None, None, :] + 0 * step[:, None]).ravel()
        ok = (x < y) & (y < len(self.n))
        x, y = x[ok], y[ok]
        nx, ny = self.n[x], self.n[y]
        ok = (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & np.ones(len(x), bool)
        x, y, nx, ny = x[ok], y[ok], nx[ok], ny[ok]
        # Bits that differ are shingles not shared: overlap <= (nx + ny - differing) / 2.
        differ = np.bitwise_count(self.bits[x] ^ self.bits[y]).sum(1, dtype=np.int64)
        ok = (100 + percent) * (nx + ny - differ) >= 2 * percent * (nx + ny)
        return x[ok], y[ok]


def _root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def possible_links(n: np.ndarray, bits: np.ndarray, label: np.ndarray | None, side: np.ndarray | None, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that may be similar enough, by a dual traversal of the tree.

    Without ``label`` the pairs are a spanning forest of the possible links;
    with it, all possible links between sets of unlike labels.  With ``side``,
    only pairs of unlike sides.
    """
    order = np.lexsort((*bits.T, n))
    tree = SignatureTree(n[order], bits[order].view(np.uint64))
    i, j = tree.leaf_pairs(percent)
    m, forest = len(n), label is None
    group = np.arange(m) if forest else np.unique(label[order], return_inverse=True)[1]
    parent = list(range(m)) if forest else []
    at = np.arange(0, m, LEAF)
    # Leaves with themselves, then with the first, then the rest.
    rank = np.argsort(np.where(i == j, 0, np.where(i == 0, 1, 2)), kind="stable")
    i, j = i[rank], j[rank]
    out_x, out_y = [], []
    for a in range(0, len(i), 64):
        li, lj = i[a : a + 64], j[a : a + 64]
        low, high = np.minimum.reduceat(group, at), np.maximum.reduceat(group, at)
        open_ = ~((low[li] == high[li]) & (low[lj] == high[lj]) & (low[li] == low[lj]))
        if not open_.any():
            continue
        x, y = tree.possible(li[open_], lj[open_], percent)
        apart = group[x] != group[y]
        if side is not None:
            apart &= side[order][x] != side[order][y]
        x, y = x[apart], y[apart]
        if forest:
            keep = np.zeros(len(x), bool)
            for k, (p, q) in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
                p, q = _root(parent, p), _root(parent, q)
                if p != q:
                    parent[max(p, q)] = min(p, q)
                    keep[k] = True
            x, y = x[keep], y[keep]
            if len(x):
                group = np.array([_root(parent, p) for p in range(m)])
        out_x.append(order[x])
        out_y.append(order[y])
    none = np.empty(0, int)
    return np.concatenate([none, *out_x]), np.concatenate([none, *out_y])


def _links(members: DataFrame, keys: list[str], percent: int, labelled: bool, sided: bool) -> DataFrame:
    """(a, b) with a < b: what ``possible_links`` gives for each block of ``members`` (keys, node, n, bits, label, side)."""
    ordered = members.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in _ended(batches):
            if batch is None:
                table = carried
            else:
                part = {name: batch.column(name).to_numpy() for name in batch.schema.names}
                table = part if carried is None else {k: np.concatenate([carried[k], part[k]]) for k in part}
            if table is None or not len(table["node"]):
                continue
            m = len(table["node"])
            change = np.zeros(m, bool)
            change[0] = True
            for k in keys:
                change[1:] |= table[k][1:] != table[k][:-1]
            start = np.flatnonzero(change)
            end = np.r_[start[1:], m]
            if batch is not None:
                carried = {k: v[start[-1] :] for k, v in table.items()}
                start, end = start[:-1], end[:-1]
            bits = np.stack([table[b] for b in BITS], 1)
            n, node = table["n"], table["node"]
            a, b = [], []
            two = start[end - start == 2]
            if len(two):
                # A block of two is a tree of one leaf; all of them at once.
                nx, ny = n[two], n[two + 1]
                differ = np.bitwise_count((bits[two] ^ bits[two + 1]).view(np.uint64)).sum(1, dtype=np.int64)
                ok = (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & ((100 + percent) * (nx + ny - differ) >= 2 * percent * (nx + ny))
                if labelled:
                    ok &= table["label"][two] != table["label"][two + 1]
                if sided:
                    ok &= (table["i"][two] == table["j"][two]) | (table["side"][two] != table["side"][two + 1])
                a.append(node[two[ok]])
                b.append(node[two[ok] + 1])
            for s, e in zip(start[end - start > 2].tolist(), end[end - start > 2].tolist(), strict=True):
                apart = table["side"][s:e] if sided and table["i"][s] != table["j"][s] else None
                x, y = possible_links(n[s:e], bits[s:e], table["label"][s:e] if labelled else None, apart, percent)
                a.append(node[s + x])
                b.append(node[s + y])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return ordered.mapInArrow(run, "a long, b long").distinct()


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs that bitmaps as wide as the sets allow; the tree's are narrow for long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nx, ny, x, y = (batch.column(c).to_pylist() for c in ("nx", "ny", "x", "y"))
            ok = [(100 + percent) * (i + j - _differing(p, q)) >= 2 * percent * (i + j) for i, j, p, q in zip(nx, ny, x, y, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda end, n, bits: nodes.select(F.col("node").alias(end), F.col("n").alias(n), F.col("wide").alias(bits))
    return pairs.join(side("a", "nx", "x"), "a").join(side("b", "ny", "y"), "b").select("a", "b", "nx", "ny", "x", "y").mapInArrow(run, "a long, b long")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _texts(docs: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """(node, packed): the compressed text of a document of each node of ``asked``."""
    wanted = nodes.join(asked, "node", "left_semi").select("node", F.col("doc").alias("doc_id"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([squeeze(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()], pa.binary())], names=["doc_id", "packed"])

    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(pack, "doc_id long, packed binary")
    return freeze(packed.join(broadcast_if_small(wanted), "doc_id").select("node", "packed"))


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked): whether the full sets of each pair are similar enough.

    The text of b travels to that of a.  A text that is not of its node (rows
    with one id may differ) verifies nothing.
    """

    def linked(rows: list[tuple[int, int, int, int]], whole: list[bytes]) -> pa.RecordBatch:
        """Rows are a, b and the places of their texts in ``whole``."""
        s, at = shingle_sets(b"".join(whole), np.r_[0, np.cumsum([len(t) for t in whole], dtype=np.int64)], size)
        node, at, a, b, ok = _keys(s, at).tolist(), at.tolist(), [], [], []
        for i, j, x, y in rows:
            if node[x] == i and node[y] == j:
                nx, ny = at[x + 1] - at[x], at[y + 1] - at[y]
                both = np.concatenate([s[at[x] : at[x + 1]], s[at[y] : at[y + 1]]])
                both.sort()
                both = int(np.count_nonzero(both[1:] == both[:-1]))
                a.append(i)
                b.append(j)
                ok.append(100 * both >= percent * (nx + ny - both))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(ok, pa.bool_())], names=["a", "b", "linked"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows, whole, packed, held = [], [], b"", 0
            for i, j, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "x", "y")), strict=True):
                if packed != x or not rows:
                    packed, at = x, len(whole)
                    whole.append(unpack(x))
                    held += len(whole[-1])
                whole.append(unpack(y))
                held += len(whole[-1])
                rows.append((i, j, at, len(whole) - 1))
                if held >= PIECE:
                    yield linked(rows, whole)
                    rows, whole, held = [], [], 0
            if rows:
                yield linked(rows, whole)

    sent = texts.select(F.col("node").alias("b"), F.col("packed").alias("y")).join(broadcast_if_small(pairs), "b")
    near = texts.select(F.col("node").alias("a"), F.col("packed").alias("x")).join(broadcast_if_small(pairs.select("a").distinct()), "a", "left_semi")
    joined = sent.join(near, "a")
    return joined.select("a", "b", "x", "y").mapInArrow(check, "a long, b long, linked boolean").distinct()


def _ends(edges: DataFrame, label: DataFrame) -> DataFrame:
    """``edges`` with la and lb, the labels of their ends (the node itself if it has none)."""
    one, two = label.select(F.col("node").alias("a"), F.col("label").alias("la")), label.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    return edges.join(one, "a", "left").join(two, "b", "left").withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")})


def _relabelled(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (node, label) after the groups at both ends of ``links`` have become one."""
    groups = components(_ends(links, label).select(F.col("la").alias("a"), F.col("lb").alias("b")))
    old = label.select("node", "label").unionByName(_nodes_of(links).join(label, "node", "left_anti").withColumn("label", F.col("node")))
    return freeze(old.join(groups.select(F.col("node").alias("label"), "component"), "label", "left").select("node", F.coalesce("component", "label").alias("label")))


def similar_groups(docs: DataFrame, size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_shingles and component_id.

    Two documents link when 100 x the intersection of their shingle sets is at
    least ``percent`` x the union; a component is what links reach, named by its
    least doc_id.  Null texts and texts without words have no shingles and stand
    alone.  Rows with one doc_id are one document.  A row without doc_id gets
    the component of the rows whose set equals its own, or null, and carries no
    link further.  Other columns are not looked at.
    """
    sets = freeze(_sets(docs, size))
    rows = sets.where("token is null")
    nodes = freeze(rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("wide").alias("wide"), *(F.first(b).alias(b) for b in BITS)))
    n_nodes = nodes.count()
    common = (
        sets.where("token is not null")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") > n_nodes // FREQUENT)
        .orderBy(F.desc("seen"), "token")
        .limit(MAX_FREQUENT)
        .toPandas()
    )
    tokens = common["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    blocks = freeze(_blocks(_prefixes(docs, size, percent, (tokens[order], common["seen"].to_numpy(np.int64)[order]))))

    asked = nodes.where("doc is not null").drop("wide")
    first = freeze(_plausible(_links(blocks.join(asked, "node"), ["block", "chunk"], percent, False, False), nodes, percent))
    texts = _texts(docs, nodes, _nodes_of(first))

    # Each node is held against one other first; most groups are whole then.
    lead = freeze(first.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    lead = freeze(_verified(lead, texts, size, percent))
    label = _relabelled(rows.sparkSession.createDataFrame([], "node long, label long"), lead.where("linked").select("a", "b"))
    rest = freeze(_ends(first.join(lead, ["a", "b"], "left_anti"), label).where("la <> lb").select("a", "b"))
    rest = freeze(_verified(rest, texts, size, percent))
    label = _relabelled(label, rest.where("linked").select("a", "b"))
    checked = lead.unionByName(rest).select("a", "b")

    # Blocks whose sets are not all of one group by now, cut into pairs of chunks.
    labelled = freeze(blocks.join(label, "node", "left").select("block", "chunk", "node", F.coalesce("label", "node").alias("label")))
    open_ = labelled.groupBy("block").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("chunk").alias("last"), F.count("*").alias("m")).where("low <> high and m > 2").select("block", "last")
    other = F.explode(F.sequence(F.least(F.col("last"), F.lit(0)), F.col("last"))).alias("other")
    paired = (
        labelled.join(open_, "block")
        .select("block", "node", "label", F.col("chunk").alias("side"), other)
        .select("block", "node", "label", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    )
    second = _links(paired.join(asked, "node"), ["block", "i", "j"], percent, True, True)
    second = freeze(_plausible(second.join(checked, ["a", "b"], "left_anti"), nodes, percent))
    texts = texts.unionByName(_texts(docs, nodes, _nodes_of(second).join(texts, "node", "left_anti")))
    more = _verified(second, texts, size, percent).where("linked").select("a", "b")
    label = _relabelled(label, freeze(more.unionByName(_same_id(rows))))

    groups = label.join(nodes.select("node", "doc"), "node").groupBy("label").agg(F.min("doc").alias("component_id"))
    named = label.join(groups, "label").select("node", "component_id")
    return (
        rows.select("doc_id", "node", "n")
        .join(nodes.select("node", "doc").join(named, "node", "left"), "node", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc", "doc_id").alias("component_id"))
    )


def _same_id(rows: DataFrame) -> DataFrame:
    """Links between the nodes of rows with one doc_id but other sets."""
    several = rows.where("doc_id is not null and node is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("high")).where("a <> high").select("doc_id", "a")
    return rows.join(several, "doc_id").where("node is not null and node <> a").select("a", F.col("node").alias("b")).distinct()
