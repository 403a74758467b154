"""WARC archives: writing, normalising a monolithic gzip stream, reading back by offset.

``write`` makes archives as they come from careless writers: one gzip stream over the whole file.
``normalise`` inflates such a stream once from start to end, rewrites every record as a gzip member of its
own and writes a sidecar index (a line per record: offset, length, record id). ``read`` seeks by the index
and inflates single members. Archives lie in a folder that all executors reach, through Arrow's file
systems; a task's files have the attempt in their name, and only those that a finished task reports count.

Of records with equal payloads the one with the largest id is the response, the others are revisits that
refer to it and hold no payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellspark.llm.common import ship
from cellspark.plans.scale import checkpoint_root, materialize

#: Uncompressed bytes after which a new archive begins.
ARCHIVE_BYTES = 32 << 20
LEVEL = 4
_READ = 1 << 20
_END = b"\r\n\r\n"
_GZIP = 31
_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = b"2024-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page is None else b"%d" % page)


def _page(name: bytes) -> int | None:
    number = name.removeprefix(b"<urn:page:").removesuffix(b">")
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or with ``refers_to`` a revisit, as bytes."""
    revisit = refers_to is not None
    target = (url or "").encode().replace(b"\r", b"%0D").replace(b"\n", b"%0A")
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + _name(page),
        b"WARC-Date: " + _DATE,
        b"WARC-Target-URI: " + target,
        b"WARC-Payload-Digest: sha1:" + digest(payload).encode(),
        b"Content-Type: text/html; charset=utf-8",
    ]
    if revisit:
        head += [
            b"WARC-Refers-To: " + _name(refers_to),
            b"WARC-Profile: " + _PROFILE,
            b"X-Payload-Length: %d" % len(payload),
        ]
    body = b"" if revisit else payload
    head.append(b"Content-Length: %d" % len(body))
    return b"\r\n".join(head) + _END + body + _END


def parse(data: bytes | bytearray, at: int = 0) -> tuple[dict[bytes, bytes], int, int] | None:
    """Header fields, where the body begins and where the record at ``at`` ends; None if it is not all there."""
    cut = data.find(_END, at)
    if cut < 0:
        return None
    lines = bytes(data[at:cut]).split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines[1:])}
    begin = cut + len(_END)
    end = begin + int(fields[b"content-length"]) + len(_END)
    return (fields, begin, end) if len(data) >= end else None


def _inflated(source) -> Iterator[bytes]:
    """What a gzip file holds, a bounded piece at a time; more streams may follow the first."""
    inflate = zlib.decompressobj(_GZIP)
    while chunk := source.read(_READ):
        while chunk:
            yield inflate.decompress(chunk, _READ)
            chunk = inflate.unconsumed_tail
            if inflate.eof:
                chunk, inflate = inflate.unused_data, zlib.decompressobj(_GZIP)
    yield inflate.flush()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _attempt() -> str:
    task = TaskContext.get()
    return f"{task.partitionId():06d}-{task.taskAttemptId()}"


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        number, size, out, squeeze = 0, 0, None, None
        done: list[str] = []

        def close() -> None:
            nonlocal out, size
            if out:
                out.write(squeeze.flush())
                out.close()
                out, size = None, 0

        for batch in batches:
            columns = (batch.column(c) for c in ("page", "url", "payload", "refers_to"))
            for page, url, payload, refers_to in zip(*columns):
                data = record(page.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                if out and size + len(data) > archive_bytes:
                    close()
                if not out:
                    name = f"mono-{_attempt()}-{number:05d}.warc.gz"
                    out = system.open_output_stream(f"{root}/{name}", compression=None)
                    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
                    done.append(name)
                    number += 1
                out.write(squeeze.compress(data))
                size += len(data)
        close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.string())], ["archive"])

    return run


def write(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """archive: the names of the monolithic archives that hold a record per row.

    The payload is the text in UTF-8, a null one is empty; a null url is an empty target, line ends in a
    url are escaped. Payloads of under ``revisit_bytes`` bytes are responses each. Among equal payloads
    all rows with the largest id are responses; a null id is smaller than any other, and where all are
    null all are responses. Other columns are left out.
    """
    ship(pages.sparkSession)
    _create(folder)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    ).withColumn("sha1", F.sha1("payload"))
    # only digests meet, counted in each task first, however many copies there are
    keys = rows.filter(F.octet_length("payload") >= revisit_bytes).select("page", "sha1")
    newest = keys.groupBy("sha1").agg(F.max("page").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    revisits = (
        keys.join(newest.filter("n > 1"), "sha1")
        .filter("page is null or page < refers_to")
        .select(F.col("page").alias("r_page"), F.col("sha1").alias("r_sha1"), "refers_to")
        .distinct()
    )
    same = F.col("page").eqNullSafe(F.col("r_page")) & (F.col("sha1") == F.col("r_sha1"))
    marked = rows.join(revisits, same, "left").select("page", "url", "payload", "refers_to")
    return materialize(marked.mapInArrow(_write(folder, archive_bytes), "archive string"))


def _create(folder: str) -> None:
    system, root = _open(folder)
    system.create_dir(root, recursive=True)


def _normalise(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                target = f"{name.removeprefix('mono-').removesuffix('.warc.gz')}-{_attempt()}"
                records = 0
                with (
                    system.open_input_stream(f"{root}/{name}", compression=None) as source,
                    system.open_output_stream(f"{root}/{target}.warc.gz", compression=None) as out,
                    system.open_output_stream(f"{root}/{target}.idx", compression=None) as index,
                ):
                    held, offset = bytearray(), 0
                    for piece in _inflated(source):
                        held += piece
                        begin = 0
                        while found := parse(held, begin):
                            fields, _, end = found
                            squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
                            member = squeeze.compress(bytes(held[begin:end])) + squeeze.flush()
                            out.write(member)
                            index.write(b"%d %d %s\n" % (offset, len(member), fields[b"warc-record-id"]))
                            offset += len(member)
                            begin = end
                            records += 1
                        del held[:begin]
                    if held:
                        raise ValueError(f"{name} ends inside a record")
                yield pa.RecordBatch.from_pylist([{"archive": target, "records": records}])

    return run


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """archive, records: the archives rewritten with a member per record, each with its ``.idx`` sidecar."""
    ship(archives.sparkSession)
    return materialize(_one_each(archives).mapInArrow(_normalise(folder), "archive string, records long"))


def _one_each(archives: DataFrame) -> DataFrame:
    """The names of archives, dealt out so that each is a task's work however small the rows are."""
    return archives.select("archive").repartition(max(1, archives.count()))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{name}.idx", compression=None) as source:
                    lines = source.read().splitlines()
                rows = []
                with system.open_input_file(f"{root}/{name}.warc.gz") as archive:
                    for line in lines:
                        offset, length, _ = line.split(b" ", 2)
                        archive.seek(int(offset))
                        data = zlib.decompress(archive.read(int(length)), _GZIP)
                        fields, begin, end = parse(data)
                        body = data[begin : end - len(_END)]
                        kind = fields[b"warc-type"].decode()
                        stated = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
                        if kind == "response" and digest(body) != stated:
                            raise ValueError(f"{name}: payload and digest differ")
                        size = len(body) if kind == "response" else int(fields[b"x-payload-length"])
                        refers_to = _page(fields[b"warc-refers-to"]) if kind == "revisit" else None
                        rows.append(
                            (_page(fields[b"warc-record-id"]), size, stated, kind, refers_to, body)
                        )
                        if len(rows) >= 256:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return run


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def read(archives: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, payload: a row per record.

    Every record is fetched by its offset; a response whose payload does not have the stated digest is an
    error. The payload of a revisit is empty, its bytes and digest are those of the full payload.
    """
    ship(archives.sparkSession)
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )
    return _one_each(archives).mapInArrow(_read(folder), schema)


def new_folder(spark: SparkSession) -> str:
    """A new folder for archives under the session's shared folder."""
    return f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"
