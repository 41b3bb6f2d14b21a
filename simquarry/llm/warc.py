"""WARC archives with segmented records: writing, and reassembly on reading.

A record longer than ``SEGMENT`` characters is cut into a first segment and
continuation records, which name the first by ``WARC-Segment-Origin-ID``.  The
HTTP body is in chunked transfer framing.  The version line never stands in an
archive but at the head of a record, so archives can be read in splits: chunks end
inside every ``WARC/1.1`` of a payload, whatever follows it, as line ends also come
from the framing and from the writer.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simquarry.session import shared_folder

NAME = "WARC/1.1"
VERSION = f"{NAME}\r\n"
END = "\r\n\r\n"
SEGMENT = 16_384  # characters of a block in one record
CHUNK = 4_096  # characters in one chunk
MIN_PAYLOAD = 100  # bytes from which equal payloads are stored once
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"

RECORD = "record_id string, record_type string, page_id long, refers_to long, digest string, origin string, segment int, total long, intact boolean, block binary"
PAYLOAD = "page_id long, record_type string, refers_to long, digest string, status string, payload binary"


def chunked(payload: str) -> str:
    """``payload`` in chunked framing; no chunk holds the name of the version line."""
    cuts = {*range(0, len(payload), CHUNK), len(payload), *(m.start() + 5 for m in re.finditer(re.escape(NAME), payload))}
    ends = sorted(cuts)
    body = "".join(f"{len(piece.encode()):x}\r\n{piece}\r\n" for a, b in zip(ends, ends[1:], strict=False) if (piece := payload[a:b]))
    return f"{body}0\r\n\r\n"


def unchunked(block: bytes) -> bytes | None:
    """The body of an HTTP response; None if its framing is broken."""
    head, found, rest = block.partition(b"\r\n\r\n")
    if not found:
        return None
    if not re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head):
        return rest
    out, at = [], 0
    while True:
        line = rest.find(b"\r\n", at)
        size = re.fullmatch(rb"([0-9A-Fa-f]+)[ \t]*(;.*)?", rest[at:line]) if line >= 0 else None
        if size is None:
            return None
        n = int(size[1], 16)
        if n == 0:
            return b"".join(out)
        piece = rest[line + 2 : line + 2 + n]
        if len(piece) < n or rest[line + 2 + n : line + 4 + n] != b"\r\n":
            return None
        out.append(piece)
        at = line + 4 + n


def _record(fields: list[tuple[str, object]], block: str) -> str:
    size = len(block.encode())
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", size)] if v is not None)
    return f"{VERSION}{lines}\r\n{block}"


def records(row: dict, record_id: str, date: str, segment: int) -> Iterator[str]:
    """The records of one page, without the line ends after them."""
    uri = None if row["url"] is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
    if uri is not None and uri.endswith(NAME):
        uri = f"{uri[:-1]}%31"
    common = [("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), ("WARC-Target-URI", uri), ("X-Page-ID", row["page_id"]), ("WARC-Payload-Digest", f"sha256:{row['digest']}"), ("Content-Type", "application/http; msgtype=response")]
    if row["refers_to"] is not None:
        yield _record([("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page-ID", row["refers_to"]), *common], "HTTP/1.1 200 OK\r\n\r\n")
        return
    block = HTTP_HEAD + chunked(row["html"] or "")
    if len(block) <= segment:
        yield _record([("WARC-Type", "response"), *common], block)
        return
    # No part ends with the name of the version line: chunks have parted all of them.
    parts = [block[a : a + segment] for a in range(0, len(block), segment)]
    yield _record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1)], parts[0])
    for k, part in enumerate(parts[1:], 2):
        last = ("WARC-Segment-Total-Length", len(block.encode()) if k == len(parts) else None)
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{record_id}:{k}>"), ("WARC-Date", date), ("WARC-Segment-Origin-ID", f"<{record_id}>"), ("WARC-Segment-Number", k), last], part)


def plan_records(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and refers_to.

    Of rows with equal payloads of ``min_payload`` bytes or more, those with the
    least page_id are responses, and the others revisit it.  Null payloads are
    empty.  A row without page_id is a response if no equal row has an id.
    """
    body = F.coalesce("html", F.lit(""))
    seen = pages.select("page_id", "url", "html", F.sha2(body.cast("binary"), 256).alias("digest"), F.octet_length(body).alias("n_bytes"))
    firsts = seen.where(F.col("n_bytes") >= min_payload).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return seen.join(firsts.hint("shuffle_hash"), "digest", "left").select("page_id", "url", "html", "digest", F.when((F.col("page_id") != F.col("first")) | (F.col("page_id").isNull() & F.col("first").isNotNull()), F.col("first")).alias("refers_to"))


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", segment: int = SEGMENT, min_payload: int = MIN_PAYLOAD) -> None:
    """Write one record (or its segments) for each row of ``pages`` to gzipped archives in ``path``.

    All segments of a record are written by one task to one archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, size = [], 0
            for row in batch.to_pylist():
                n += 1
                for record in records(row, f"urn:page:{row['page_id']}:{row['digest'][:16]}:{task}.{n}", date, segment):
                    out.append(record)
                    size += len(record)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    plan_records(pages, min_payload).mapInArrow(run, "value string").write.option("lineSep", END).option("compression", "gzip").text(path)


def new_folder(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/warc-{uuid.uuid4().hex}"


def _parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))}
    number = lambda k: int(v) if re.fullmatch(r"-?\d+", v := fields.get(k, "")) else None
    size = number("content-length")
    name = lambda k: fields[k].strip("<>") if k in fields else None
    return {
        "record_id": name("warc-record-id"),
        "record_type": fields.get("warc-type"),
        "page_id": number("x-page-id"),
        "refers_to": number("x-refers-to-page-id"),
        "digest": fields.get("warc-payload-digest", "").removeprefix("sha256:") or None,
        "origin": name("warc-segment-origin-id") or name("warc-record-id"),
        "segment": number("warc-segment-number"),
        "total": number("warc-segment-total-length"),
        # What follows a block is the two line ends before the next record; where nothing
        # follows, line ends at the end may stand in for what was cut off.
        "intact": size is not None and 0 <= size <= len(rest) and (rest[size:] == b"\r\n\r\n" or (len(rest) == size and not rest.endswith(b"\r\n\r\n"))),
        "block": rest[:size] if size is not None else rest,
    }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in ``path``, continuation records on their own."""
    schema = spark.createDataFrame([], RECORD).schema
    arrow = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("value").to_pylist()
            for at in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist([_parse(x) for x in rows[at : at + 256]], arrow)

    raw = spark.read.option("lineSep", VERSION).text(path).where("value <> ''")
    return raw.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: page_id, record_type, refers_to, digest, status and payload.

    Continuation records are grouped by their origin and put in the order of
    their segment numbers; the numbers must run from 1 without a gap, and the
    length must be that of ``WARC-Segment-Total-Length``.  Then the transfer
    framing is taken off.  ``status`` is ok, cut (a block shorter or longer than
    its Content-Length), missing_segment, wrong_length or bad_framing; payloads
    are null unless ok.  A revisit has no payload of its own.  Segments of one
    record meet in one task by need; records that are whole are not shuffled.
    """
    rows = read_records(spark, path)
    whole = rows.where("segment is null").select("page_id", "record_type", "refers_to", "digest", F.col("total"), F.array(F.struct(F.lit(1).alias("segment"), "intact", "block")).alias("parts"))
    split = (
        rows.where("segment is not null")
        .groupBy("origin")
        .agg(
            F.max("page_id").alias("page_id"),
            F.max(F.when(F.col("segment") == 1, F.col("record_type"))).alias("record_type"),
            F.max("refers_to").alias("refers_to"),
            F.max("digest").alias("digest"),
            F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("segment", "intact", "block"))).alias("parts"),
        )
        .drop("origin")
    )
    arrow = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("digest", pa.string()), ("status", pa.string()), ("payload", pa.binary())])

    def joined(row: dict) -> dict:
        parts, payload = row.pop("parts"), None
        total = row.pop("total")
        block = b"".join(p["block"] for p in parts)
        if not all(p["intact"] for p in parts):
            status = "cut"
        elif [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or (len(parts) == 1) != (total is None):
            status = "missing_segment"
        elif total is not None and total != len(block):
            status = "wrong_length"
        elif row["record_type"] == "revisit":
            status = "ok"
        else:
            payload = unchunked(block)
            status = "bad_framing" if payload is None else "ok"
        return row | {"status": status, "payload": payload}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield pa.RecordBatch.from_pylist([joined(r) for r in batch.slice(at, 256).to_pylist()], arrow)

    return whole.mapInArrow(run, PAYLOAD).unionByName(split.mapInArrow(run, PAYLOAD))
