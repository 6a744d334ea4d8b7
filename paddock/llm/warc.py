"""WARC archives: written by tasks, read back by byte ranges.

Every record is a gzip member of its own.  The reader cuts archives into ranges; a task
looks for the gzip magic in its range, takes a place for a member only if it inflates to a
WARC header, and owns the records that start inside its range, reading past its end where
the last one needs it.

Archives live in a folder that all tasks reach by its URI, such as one below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, identified, materialize

MIN_BYTES = 0  # smaller payloads are never revisits
SPLIT_BYTES = 16 << 20
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 18
_FLUSH = 16 << 20


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location as Spark writes it: not encoded, local ones as file:/."""
    local = re.match(r"(?:file:)?/+(.*)", uri)
    if local:
        return fs.LocalFileSystem(), f"/{local[1]}"
    return fs.FileSystem.from_uri(quote(uri, safe="/:@?=&,"))


def _header(lines: list[tuple[str, str]]) -> bytes:
    """Header lines; line breaks and other controls in values are percent-encoded."""
    clean = [(k, re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", v)) for k, v in lines]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in clean) + "\r\n").encode()


def record(kind: str, name: str, url: str | None, digest: str, refers_to: str | None, payload: bytes) -> bytes:
    """One record, compressed as a gzip member."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", DATE)]
    if url is not None:
        lines.append(("WARC-Target-URI", url))
    lines.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    lines += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return gzip.compress(_header(lines) + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324


def _writer(folder: str):
    """Batches of records to one archive a task; a repeated task replaces its file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        system, path = _open(folder)
        final = f"{path}/part-{task.partitionId():06d}.warc.gz"
        draft = f"{path}/.{task.partitionId():06d}-{task.taskAttemptId()}.tmp"
        count = 0
        out = None
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    out = system.open_output_stream(draft)
                payload = (row["payload"] or "").encode("utf-8", "surrogatepass")
                kind = "response" if row["refers_to"] is None else "revisit"
                out.write(record(kind, row["name"], row["url"], base32_sha1(payload), row["refers_to"], payload))
                count += 1
        if out is not None:
            out.close()
            system.move(draft, final)
            yield pa.RecordBatch.from_pydict({"path": [final], "records": [count]})

    return run


def write(
    pages: DataFrame,
    folder: str,
    min_bytes: int = MIN_BYTES,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Writes one record a row and returns path and records of every archive, stored.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the smallest
    id is a response, of equal ids the first, and the others revisit it; a null id comes
    last.  A null html is an empty payload, a null url is left out.  An empty table writes
    no archive.
    """
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    payload = F.coalesce(pages[html_col], F.lit(""))
    stored = materialize(
        identified(
            pages,
            id=pages[id_col].cast("string"),
            rank=pages[id_col],
            url=pages[url_col],
            payload=pages[html_col],
            digest=F.unhex(F.sha1(payload)),
            size=F.octet_length(payload),
        ),
        "pages",
    )
    slim = stored.select("tag", "id", "rank", "digest", "size")
    able = slim.where(F.col("size") >= min_bytes)
    order = F.min(F.struct(F.col("rank").isNull(), "rank", "tag", "id"))
    first = materialize(able.groupBy("digest", "size").agg(order.alias("first")), "payloads")
    revisits = attach(able, first, ["digest", "size"]).where("tag <> first.tag")
    refers = materialize(revisits.select("tag", _name("first.id", "first.tag").alias("refers_to")), "revisits")
    rows = stored.select("tag", _name("id", "tag").alias("name"), "url", "payload").join(refers, "tag", "left")
    written = rows.select("name", "url", "payload", "refers_to").mapInArrow(_writer(folder), "path string, records long")
    return materialize(written, "archives")


def _name(id_col: str, tag: str):
    """Record id of a row: repeated ids differ by their tags."""
    return F.concat(F.lit("urn:x-page:"), F.coalesce(id_col, F.lit("")), F.lit(":"), F.col(tag).cast("string"))


def _inflate(file, size: int, at: int) -> tuple[bytes, int, str | None] | None:
    """Content and end of the member at ``at`` and what is wrong with it; None if it is no record.

    A member that begins as a record but ends with the file, or cannot be inflated further,
    gives what was read; the search goes on behind its first bytes.
    """
    member, data, pos, error = zlib.decompressobj(31), [], at, None
    try:
        while not member.eof:
            step = min(_READ if data else 4096, size - pos)
            if step <= 0:
                error = "truncated"
                break
            data.append(member.decompress(file.read_at(step, pos)))
            pos += step
            if len(data) == 1 and not data[0].startswith(b"WARC/1."):
                return None
    except zlib.error:
        error = "corrupt"
    if not data:
        return None
    return b"".join(data), at + 1 if error else pos - len(member.unused_data), error


def _owned(file, size: int, start: int, end: int) -> Iterator[tuple[int, bytes, str | None]]:
    """Offset, content and fault of the records that start in [start, end)."""
    at = start
    while at < end:
        window = file.read_at(min(_READ, min(end + len(_MAGIC) - 1, size) - at), at)
        found = window.find(_MAGIC)
        if found < 0:
            if len(window) < len(_MAGIC):
                return
            at += len(window) - len(_MAGIC) + 1
            continue
        at += found
        if at >= end:
            return
        member = _inflate(file, size, at)
        if member is None:
            at += 1
        else:
            yield at, member[0], member[2]
            at = member[1]


def parse(content: bytes) -> tuple[dict[str, str], bytes, str | None]:
    """Header fields, by lower-case name, the block of a record and what is wrong with it.

    A field is split at its first colon, a line that begins with a blank goes on with the
    field before.  A record without a type or a usable length is returned as far as it goes.
    """
    head, _, rest = content.partition(b"\r\n\r\n")
    fields: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            fields[last] = f"{fields[last]} {line.strip()}"
        elif ":" in line:
            name, _, value = line.partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
    length = fields.get("content-length", "")
    error = None if "warc-type" in fields else "no type"
    if not (length.isascii() and length.isdigit()):
        return fields, rest, error or "no length"
    if len(rest) < int(length):
        return fields, rest, error or "truncated"
    return fields, rest[: int(length)], error


def _payload(kind: str | None, fields: dict[str, str], block: bytes) -> bytes | None:
    """What a record carries: the body of an HTTP message, else its block; none for a revisit."""
    if kind in (None, "revisit"):
        return None
    if fields.get("content-type", "").lower().startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _reader(with_payload: bool):
    names = ["path", "offset", "record_type", "record_id", "refers_to", "target_uri", "payload_digest", "stated_digest", "payload_bytes", "payload", "error"]
    types = [pa.string(), pa.int64(), *[pa.string()] * 6, pa.int64(), pa.binary(), pa.string()]

    def rows(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for batch in batches:
            for part in batch.to_pylist():
                system, path = _open(part["path"])
                with system.open_input_file(path) as file:
                    for offset, content, fault in _owned(file, part["length"], part["start"], part["end"]):
                        fields, block, error = parse(content)
                        kind = fields.get("warc-type")
                        payload = _payload(kind, fields, block)
                        bare = [fields.get(k, "").strip("<>") or None for k in ("warc-record-id", "warc-refers-to")]
                        held.append(
                            (
                                part["path"], offset, kind, *bare, fields.get("warc-target-uri"),
                                None if payload is None else base32_sha1(payload),
                                fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                                None if payload is None else len(payload),
                                payload if with_payload else None,
                                fault or error,
                            )
                        )
                        weight += 1000 + len(payload or b"") * with_payload
                        if weight >= _FLUSH:
                            yield rows(held)
                            held, weight = [], 0
        if held:
            yield rows(held)

    return run


_RECORD = (
    "path string, offset long, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, stated_digest string, payload_bytes long, payload binary, error string"
)


def read(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """Every record of the ``.warc.gz`` files below ``folder``, of whatever type.

    ``payload_digest`` and ``payload_bytes`` are computed from the payload read and null
    for revisits, ``stated_digest`` is the header's.  ``error`` is null for a whole record; one
    that is cut off or cannot be inflated further (truncated, corrupt) or lacks its type or
    a usable length has what could be read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
    listed = files.load(folder).select("path", "length").where("length > 0")
    ranges = listed.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))))
    ranges = ranges.withColumn("end", F.least("length", F.col("start") + split_bytes))
    # a task for each range: left to itself, adaptive execution would join such short rows
    tasks = max(1, ranges.count())
    return ranges.repartition(tasks).mapInArrow(_reader(with_payload), _RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Stored records with the payload's bytes and digest also for revisits.

    A revisit takes them from the response it refers to, whose digest must be the one
    it states; otherwise they stay null.  Records of other types stay as they are.
    """
    plain = records.where("record_type is null or record_type <> 'revisit'")
    target = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("found")
    )
    # two plain shuffles: adaptive execution splits a response with very many revisits
    again = records.where("record_type = 'revisit'").join(target, "refers_to", "left")
    same = F.col("found") == F.col("stated_digest")
    again = again.withColumn("payload_bytes", F.when(same, F.col("bytes"))).withColumn(
        "payload_digest", F.when(same, F.col("found"))
    )
    return plain.unionByName(again.select(*plain.columns))
