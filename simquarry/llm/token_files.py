"""Token ids in ORC files.

ORC writes integers run-length encoded in stripes, with an index every
``STRIDE`` rows and a Bloom filter on doc_id, so a reader takes the stripes of
a file in parallel and skips those that cannot hold a document.  Files follow
doc_id: each holds a range of them in order.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from simquarry.llm.bpe import packed, slices
from simquarry.session import shared_folder

END_ID = 1
STRIDE = 1000
MAX_WORDS = 1_000_000  # words that a worker remembers before it starts anew

# Below U+0250 composition changes nothing and a letter's lower case does not
# depend on its neighbours; other texts go through the tokenizer whole.  So do
# those with U+001C to U+001F, which the tokenizer does not take for white space.
PLAIN = r"^[\x00-\x1b\x20-\x{24f}]*$"
# Runs that are split into letters and the rest, which are never in one word of
# the split but for endings after an apostrophe.
APART = r"^[\x00-\x26\x28-\x{24f}]*$"
LETTER = "a-zªµºß-öø-ɏ"
LETTERS = re.compile(f"[{LETTER}]+")


def _taken(ids: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the entries ``code`` of a pool in a row, and where each entry ends; ``size`` ids belong to each entry of the pool."""
    first = np.cumsum(size) - size
    n = size[code]
    stop = np.cumsum(n)
    return ids[np.arange(stop[-1] if len(stop) else 0) + np.repeat(first[code] - stop + n, n)], stop


class WordEncoder:
    """The tokenizers library, asked once for each word.

    White space is dropped by this vocabulary's split and never within a word,
    so runs between it are encoded on their own, and their letters apart from
    what stands beside them.  Words of letters are put to the library in one text:
    the last id of each is one that ends a word.  Ids are packed, four bytes
    for each.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [packed(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        if len(ends) != len(words):
            return self._ids(words)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words, of which those not met before are put to the library."""
        found = list(map(self.known.get, words))
        new = [w for w, ids in zip(words, found, strict=True) if ids is None]
        if not new:
            return found
        if len(self.known) + len(new) > MAX_WORDS:
            self.known, new = {}, words
        letters = [w for w in new if LETTERS.fullmatch(w)]
        for ask, asked in ((self._letters, letters), (self._ids, [w for w in new if not LETTERS.fullmatch(w)])):
            for at in range(0, len(asked), 2000):
                self.known.update(zip(asked[at : at + 2000], ask(asked[at : at + 2000]), strict=True))
        return [self.known[w] if ids is None else ids for w, ids in zip(words, found, strict=True)]

    def _runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs in a row, and the number of each run's ids."""
        marked = pc.replace_substring_regex(runs, f"([{LETTER}])([^{LETTER}])", r"\1 \2")
        marked = pc.replace_substring_regex(marked, f"([^{LETTER} ])([{LETTER}])", r"\1 \2")
        pieces = pc.split_pattern(pc.if_else(pc.match_substring_regex(runs, APART), marked, runs), " ")
        coded = pieces.flatten().dictionary_encode()
        pool = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, stop = _taken(np.frombuffer(b"".join(pool), "<u4"), np.fromiter(map(len, pool), np.int64, len(pool)) // 4, coded.indices.to_numpy(zero_copy_only=False))
        return ids, np.diff(np.concatenate(([0], stop))[pieces.offsets.to_numpy()])

    def encode(self, texts: list[str] | pa.Array, end: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text ends.  ``end`` is put behind each; null is empty.

        The runs of a batch become numbers first, and their pieces too, so a word
        is looked up once a batch, and ids are copied from one pool.
        """
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        plain = pc.match_substring_regex(texts, PLAIN)
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(texts, s)))
        # Only this letter becomes two, for the tokenizer; Arrow's lower case has one.
        lowered = pc.utf8_lower(pc.replace_substring(pc.if_else(plain, texts, ""), "\u0130", "i\u0307"))
        split = pc.utf8_split_whitespace(lowered)
        coded = split.flatten().dictionary_encode()
        ids, size = self._runs(coded.dictionary)
        # After the runs of a text come its ids if it went whole, and the end.
        is_whole = ~plain.to_numpy(zero_copy_only=False)
        whole = [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts.filter(pc.invert(plain)).to_pylist(), add_special_tokens=False)]
        pool = [ids, np.array(end or [], "<u4"), *whole]
        size = np.concatenate((size, [len(x) for x in pool[1:]])).astype(np.int64)
        behind = np.full(len(texts) + len(whole), len(coded.dictionary))
        behind[np.flatnonzero(is_whole) + np.arange(len(whole))] += 1 + np.arange(len(whole))
        offsets = split.offsets.to_numpy()
        code = np.insert(coded.indices.to_numpy(zero_copy_only=False), np.repeat(offsets[1:] - offsets[0], 1 + is_whole), behind)
        ids, stop = _taken(np.concatenate(pool), size, code)
        return ids, stop[np.cumsum(np.diff(offsets) + 1 + is_whole) - 1]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of this process; what it has learned serves the next task too."""
    return WordEncoder(path)


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Encode the whole texts of ``docs`` and write doc_id, ids, part and at.

    Rows go by doc_id (null first) and, where ids are equal, by a hash of the
    text, so the order is the same each time.  ``at`` counts the ids before a
    document within its range ``part``.  A null text has the end id only;
    repeated rows are written each, and other columns are not looked at.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("__tie"))
    ranged = keyed.repartitionByRange("doc_id", "__tie").sortWithinPartitions("doc_id", "__tie").withColumn("part", F.spark_partition_id())
    schema = ranged.select("doc_id", F.lit(None).cast("array<int>").alias("ids"), "part", F.lit(0).cast("long").alias("at")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in slices(batches, "text", 6 << 20):
            ids, ends = encoder(tokenizer).encode(batch.column("text"), [end_id])
            offsets = np.concatenate(([0], ends))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, batch.column("part"), pa.array(at + offsets[:-1], pa.int64())], names=["doc_id", "ids", "part", "at"])
            at += int(offsets[-1])

    (
        ranged.mapInArrow(run, schema)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(STRIDE))
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def new_folder(docs: DataFrame) -> str:
    return f"{shared_folder(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, ids and ``start``, the number of ids of all documents before, from the files of ``write``.

    Each range has one sum, so the shift of a range comes from a table with as
    many rows as there are ranges.
    """
    rows = spark.read.orc(path)
    sums = rows.groupBy("part").agg(F.max(F.col("at") + F.size("ids")).alias("n"))
    shift = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("shift"))
    return rows.join(F.broadcast(shift), "part").select("doc_id", "ids", (F.col("at") + F.col("shift")).alias("start"))


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id and ids of a few documents.

    The ids are pushed to the scan: files and stripes whose range of doc_id holds
    none are skipped by their statistics, row groups also by the Bloom filter.
    """
    return spark.read.orc(path).where(F.col("doc_id").isin([int(i) for i in doc_ids])).select("doc_id", "ids")


def digests(read_back: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the ids as little-endian 32-bit integers."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
            ends = ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return read_back.select("doc_id", "start", "ids").mapInArrow(run, schema)
