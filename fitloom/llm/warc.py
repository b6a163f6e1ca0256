"""WARC records in Zstandard archives: a dictionary in a leading skippable frame, then one frame a record.

Writing puts each record into a frame of its own, compressed with the archive's dictionary, so
records can be fetched alone.  Reading loads the dictionary, decodes frame by frame and validates
record headers, lengths and digests; any fault raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import map_texts, readers, schema, shared_folder, slices, table, written
from .wavelet import get, put

#: The skippable frame that carries a dictionary, and the frame mark of Zstandard.
SKIPPABLE, FRAME = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
#: Bytes of payload after which an archive is closed, bytes of the dictionary and of its samples.
ARCHIVE, DICTIONARY, SAMPLE = 16 << 20, 16 << 10, 1 << 20
LEVEL = 3


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """A response record, or without payload a revisit of page `first`."""
    kind = "response" if first is None else "revisit"
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Target-URI: {' '.join((url or '').split())}", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Payload-Length: {len(payload)}"]
    if first is not None:
        head += [f"WARC-Refers-To: <urn:page:{first}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join([*head, "", ""]).encode() + payload + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the first records; too few of them serve as raw content."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes() if len(samples) >= 16 else b"".join(samples)[-DICTIONARY:]
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def archive(records: list[bytes]) -> bytes:
    samples, size = [], 0
    for r in records:
        if size + len(r) > SAMPLE:
            break
        samples.append(r)
        size += len(r)
    d = dictionary(samples)
    z = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d) if d else None, write_content_size=True, write_checksum=True)
    return b"".join([struct.pack("<II", SKIPPABLE, len(d)), d, *(z.compress(r) for r in records)])


def parse(raw: bytes) -> dict[str, str | bytes]:
    """Headers (lower-case names) and payload of one record, validated."""
    head, gap, body = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("not a WARC record")
    out: dict[str, str | bytes] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name.strip() != name or name.lower() in out:
            raise ValueError(f"bad header: {line!r}")
        out[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "content-length", "warc-payload-digest"):
        if name not in out:
            raise ValueError(f"no {name}")
    if not out["content-length"].isdigit():
        raise ValueError("bad Content-Length")
    n = int(out["content-length"])
    if body[n:] != b"\r\n\r\n" or len(body) != n + 4:
        raise ValueError("the record's length is not its Content-Length")
    payload = body[:n]
    if out["warc-type"] == "response" and out["warc-payload-digest"] != f"sha1:{digest(payload)}":
        raise ValueError("the payload's digest is not WARC-Payload-Digest")
    if out["warc-type"] == "revisit" and (n or "warc-refers-to" not in out):
        raise ValueError("bad revisit record")
    return out | {"payload": payload}


def frames(data: bytes) -> Iterator[bytes]:
    """The records of an archive, each the content of one frame."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != SKIPPABLE:
        raise ValueError("no dictionary frame at the start")
    size = struct.unpack_from("<I", data, 4)[0]
    d = data[8 : 8 + size]
    if len(d) != size:
        raise ValueError("the dictionary frame is cut short")
    if d[:4] == FRAME:  # the dictionary itself may be compressed
        d = zstandard.ZstdDecompressor().decompressobj().decompress(d)
    z, at = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(d) if d else None), 8 + size
    view = memoryview(data)
    while at < len(data):
        mark = struct.unpack_from("<I", data, at)[0] if len(data) - at >= 8 else 0
        if mark & 0xFFFFFFF0 == 0x184D2A50:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        if data[at : at + 4] != FRAME:
            raise ValueError(f"no frame at {at}")
        one, out, step = z.decompressobj(), [], 1 << 16
        while not one.eof:
            if at >= len(data):
                raise ValueError("the last frame is cut short")
            try:
                out.append(one.decompress(view[at : at + step]))
            except zstandard.ZstdError as e:
                raise ValueError(f"bad frame: {e}") from e
            at = min(len(data), at + step)
        at -= len(one.unused_data)
        yield b"".join(out)


def write_archives(pages: DataFrame, least: int = 0, folder: str | None = None, limit: int = ARCHIVE) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) and returns the archives' paths.

    Of payloads alike, of `least` bytes at least, the row of least page_id is the response and others
    revisit it; of rows that tie in page_id, the one of least url, nulls first, and of rows alike in that
    too any one.  Null html is empty.  A null page_id counts as larger than any other and has an empty
    record id; payloads of null ids alone are all responses, as there is no id to refer to.  Names of
    archives hold the task's attempt, and only archives that the result names, those of attempts that
    Spark committed, are read.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = rows.withColumn("key", F.unhex(F.sha1("html")))
    alike = rows.where(F.octet_length("html") >= least).select("key", "page_id").groupBy("key", "page_id").agg(F.count("*").alias("n"))
    alike = alike.groupBy("key").agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n"))).alias("s"), F.sum("n").alias("many")).where("many > 1 and s is not null")
    first = written(alike.select("key", F.col("s.page_id").alias("first"), F.col("s.n").alias("tied")), "first")
    rows = rows.join(first, "key", "left").withColumn("leads", F.col("page_id").eqNullSafe(F.col("first")))
    if not first.where("tied > 1").isEmpty():  # rows that repeat a page_id and its payload
        tied = rows.where("leads and tied > 1").withColumn("leads", F.row_number().over(Window.partitionBy("key").orderBy("url")) == 1)
        rows = rows.where("not coalesce(leads and tied > 1, false)").unionByName(tied)
    rows = rows.select("page_id", "url", "html", F.when(~F.col("leads"), F.col("first")).alias("first"))

    def run(batches):
        part, attempt, k, held, size, made = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], 0, []

        def close():
            nonlocal k, held, size
            path = f"{folder}/part-{part:07d}-{k:05d}-{attempt}.warc.zst"
            put(path, archive(held))
            made.append((path, len(held)))
            k, held, size = k + 1, [], 0

        for whole in batches:
            for batch in slices(whole, "html"):
                for r in batch.to_pylist():
                    held.append(record(r["page_id"], r["url"], r["html"].encode(), r["first"]))
                    size += len(held[-1])
                    if size >= limit:
                        close()
        if held:
            close()
        yield from table({"path": pa.string(), "records": pa.int64()}, made).to_batches()

    return written(map_texts(rows, run, schema(None, path="string", records="long")), "archives")


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def read_archives(paths: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record of the archives: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to and, if asked for, payload (empty for revisits)."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    types = {"page_id": "long", "url": "string", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long"}
    if payloads:
        kinds["payload"], types["payload"] = pa.binary(), "binary"

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                for raw in frames(get(path)):
                    r = parse(raw)
                    row = (_page(r["warc-record-id"]), r.get("warc-target-uri"), int(r.get("warc-payload-length", len(r["payload"]))), r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"], _page(r.get("warc-refers-to")))
                    rows.append((*row, r["payload"]) if payloads else row)
                    size += len(raw) if payloads else 100
                    if size > 4 << 20:
                        yield from table(kinds, rows).to_batches()
                        rows, size = [], 0
                yield from table(kinds, rows).to_batches()

    return map_texts(paths.select("path").repartition(readers(paths.count()), "path"), run, schema(None, **types))
