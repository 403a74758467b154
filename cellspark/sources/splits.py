"""Text files in splits that can be read by themselves.

Plain files may be cut anywhere. Block-gzip files consist of small gzip members that carry their own length, so a reader
can start at any of them; a split starts at the first member that begins in its byte range. A split does not know how many
lines lie before it. One pass counts the line ends of every split, all splits at once, and prefix sums over the splits of
a file give each the number of its first whole line. The result is the line index of the files: offset of a member (or
byte), bytes to skip in it, number of the line that starts there. No row is sorted or moved for it.

Ordinary gzip, of one member or several, cannot be entered in the middle and has no index.
"""

from __future__ import annotations

import gzip
import io
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cellspark.plans.scale import materialize
from cellspark.session import ship

#: Bytes of a file that one task reads.
SPLIT_BYTES = 64 << 20
BUFFER = 1 << 20
PLAIN, BLOCKS, STREAM = "plain", "blocks", "stream"
#: A member of a block-gzip file has at most 64 KB; its header names its length in an extra field "BC" of two bytes.
MEMBER = 1 << 16
_MAGIC = b"\x1f\x8b\x08\x04"


def open_file(path: str):
    """Seekable binary file on any file system that Arrow knows."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        system, name = fs.FileSystem.from_uri(path)
    else:
        system, name = fs.LocalFileSystem(), path
    return system.open_input_file(name)


def member_length(data: bytes, at: int) -> int | None:
    """Length of the block-gzip member whose header stands at ``at``; None if there is no such header."""
    if data[at : at + 4] != _MAGIC or len(data) < at + 12:
        return None
    extra = int.from_bytes(data[at + 10 : at + 12], "little")
    field, end = at + 12, at + 12 + extra
    while field + 4 <= end <= len(data):
        size = int.from_bytes(data[field + 2 : field + 4], "little")
        if data[field : field + 2] == b"BC" and size == 2:
            return int.from_bytes(data[field + 4 : field + 6], "little") + 1
        field += 4 + size
    return None


def kind_of(path: str) -> tuple[str, int]:
    """(plain, blocks or stream; size in bytes)."""
    with open_file(path) as file:
        size = file.size()
        head = file.read(64)
    if head[:2] != b"\x1f\x8b":
        return PLAIN, size
    return (BLOCKS if member_length(head, 0) else STREAM), size


def _first_member(file, start: int, size: int) -> int | None:
    """Offset of the first member that begins at ``start`` or later; None if none does before the end.

    Bytes inside a member may look like a header, so a candidate has to inflate with the right checksum.
    """
    if start == 0:
        return 0
    file.seek(start)
    data = file.read(3 * MEMBER)
    at = data.find(_MAGIC)
    while 0 <= at <= MEMBER:
        length = member_length(data, at)
        if length and at + length <= len(data):
            rest = data[at + length : at + length + 4]
            if rest in (_MAGIC, b"") or start + at + length == size:
                try:
                    gzip.decompress(data[at : at + length])
                    return start + at
                except (OSError, EOFError, zlib.error):
                    pass
        at = data.find(_MAGIC, at + 1)
    return None


def _stretches(path: str, kind: str, start: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(offset, uncompressed data) of a split, in order."""
    with open_file(path) as file:
        at = start
        if kind == PLAIN:
            file.seek(start)
            while at < end:
                data = file.read(min(BUFFER, end - at))
                if not data:
                    return
                yield at, data
                at += len(data)
            return
        at = _first_member(file, start, size)
        if at is None:
            return
        stream = io.BufferedReader(file, BUFFER)
        stream.seek(at)
        while at < end and at < size:
            # not peeked at: the buffer may end inside the header
            head = stream.read(12)
            head += stream.read(int.from_bytes(head[10:12], "little"))
            length = member_length(head, 0)
            if length is None:
                raise ValueError(f"{path} has no member of a block-gzip file at {at}")
            yield at, gzip.decompress(head + stream.read(length - len(head)))
            at += length


def _count(batches):
    """Per split: where it really starts, line ends, uncompressed bytes, bytes up to the first line end, whether the
    last byte is a line end, and whether the file turned out not to be in blocks."""
    import pyarrow as pa

    names = ["path", "kind", "start", "offset", "ends", "bytes", "first", "closed", "broken"]
    kinds = [pa.string(), pa.string(), *[pa.int64()] * 5, pa.bool_(), pa.bool_()]
    for batch in batches:
        rows = []
        for split in batch.to_pylist():
            offset, ends, size, first, closed, broken = None, 0, 0, None, None, False
            try:
                for at, data in _stretches(split["path"], split["kind"], split["start"], split["end"], split["size"]):
                    offset = at if offset is None else offset
                    if not data:
                        continue
                    if first is None and (found := data.find(b"\n")) >= 0:
                        first = size + found + 1
                    ends += data.count(b"\n")
                    size += len(data)
                    closed = data.endswith(b"\n")
            except ValueError:
                broken = True
            rows.append((split["path"], split["kind"], split["start"], offset, ends, size, first, closed, broken))
        columns = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _kinds(batches):
    import pyarrow as pa

    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = [kind_of(p) for p in paths]
        columns = [pa.array(paths, pa.string()), pa.array([k for k, _ in found], pa.string()), pa.array([s for _, s in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["path", "kind", "size"])


def line_index(spark: SparkSession, paths: list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, kind, offset, skip, line, lines: one row per split in which a line starts, in no order.

    After ``skip`` uncompressed bytes from ``offset`` on, line number ``line`` (from 0) of the file's ``lines`` starts.
    A file that has to be streamed has one row with null ``line`` and ``lines``, an empty file none with a line.
    """
    ship(spark)
    names = sorted(set(paths))
    files = materialize(
        spark.createDataFrame([(n,) for n in names], "path string").repartition(max(1, min(len(names), 1000)))
        .mapInArrow(_kinds, "path string, kind string, size long")
    )
    count = files.agg(F.sum(F.ceil(F.col("size") / split_bytes))).first()[0] or 0
    splits = files.filter(f"kind <> '{STREAM}' and size > 0").select(
        "path", "kind", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )
    # small splits are counted several to a task, as long as all cores have some
    tasks = max(int(count) * split_bytes // SPLIT_BYTES, min(int(count), spark.sparkContext.defaultParallelism), 1)
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, F.col("size"))).repartition(tasks)
    columns = "path string, kind string, start long, offset long, ends long, bytes long, first long, closed boolean, broken boolean"
    counted = materialize(splits.mapInArrow(_count, columns))
    # a file has a row per split here, which one task sorts easily; files are spread over tasks
    whole = Window.partitionBy("path")
    before = whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    known = counted.select(
        "*",
        F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("ends_before"),
        F.coalesce(F.last("closed", ignorenulls=True).over(before), F.lit(True)).alias("fresh"),
        F.bool_or("broken").over(whole).alias("stream"),
        F.sum("ends").over(whole).alias("all_ends"),
        F.last("closed", ignorenulls=True).over(whole.orderBy("start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("shut"),
    )
    lines = F.col("all_ends") + F.when(F.col("shut"), 0).otherwise(1)
    indexed = known.filter("not stream and bytes > 0 and (fresh or first < bytes)").select(
        "path", "kind", "offset",
        F.when(F.col("fresh"), 0).otherwise(F.col("first")).alias("skip"),
        (F.col("ends_before") + F.when(F.col("fresh"), 0).otherwise(1)).alias("line"),
        lines.alias("lines"),
    )
    none = [F.lit(None).cast("long").alias(c) for c in ("offset", "skip", "line", "lines")]
    streamed = known.filter("stream").select("path").unionByName(files.filter(f"kind = '{STREAM}'").select("path")).distinct()
    return indexed.unionByName(streamed.select("path", F.lit(STREAM).alias("kind"), *none))


@dataclass
class FileLines:
    """Line index of one file, on the driver: an entry per split. ``lines`` is None if it must be streamed."""

    kind: str
    entries: list[tuple[int, int, int]]
    lines: int | None

    def entry(self, line: int) -> tuple[int, int, int]:
        """The last (line, offset, skip) at or before a line."""
        return self.entries[max(0, bisect_right(self.entries, (line, 1 << 63, 0)) - 1)]


def file_lines(index: DataFrame) -> dict[str, FileLines]:
    """The index by path. There is one row per split, and one task reads a split, so its size is that of the plan."""
    found: dict[str, FileLines] = {}
    for row in index.collect():
        file = found.setdefault(row["path"], FileLines(row["kind"], [], row["lines"]))
        if row["lines"] is not None:
            file.entries.append((row["line"], row["offset"], row["skip"]))
    for file in found.values():
        file.entries.sort()
    return found


def lines_from(path: str, kind: str, offset: int, skip: int):
    """Buffered binary stream of a file's text that starts ``skip`` bytes after ``offset``."""
    stream = io.BufferedReader(open_file(path), BUFFER)
    stream.seek(offset)
    # members follow each other, so from the start of one on the rest is a gzip file
    packed = kind == BLOCKS or (kind == STREAM and stream.peek(2)[:2] == b"\x1f\x8b")
    text = io.BufferedReader(gzip.GzipFile(fileobj=stream), BUFFER) if packed else stream
    while skip > 0:
        skip -= len(text.read(min(skip, BUFFER)))
    return text


def write_index(index: DataFrame, path: str) -> None:
    """Keep an index beside the data, for later reads of the same files."""
    index.coalesce(1).write.mode("overwrite").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def pack_blocks(data: bytes, level: int = 6) -> bytes:
    """``data`` as consecutive members of a block-gzip file (without the empty one that ends a file)."""
    out = []
    for at in range(0, len(data), 65280):
        piece = data[at : at + 65280]
        packer = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = packer.compress(piece) + packer.flush()
        if len(body) > MEMBER - 64:  # does not shrink: stored as it is
            packer = zlib.compressobj(0, zlib.DEFLATED, -15)
            body = packer.compress(piece) + packer.flush()
        size = len(body) + 26
        head = _MAGIC + bytes([0, 0, 0, 0, 0, 255]) + (6).to_bytes(2, "little") + b"BC" + (2).to_bytes(2, "little")
        tail = zlib.crc32(piece).to_bytes(4, "little") + len(piece).to_bytes(4, "little")
        out.append(head + (size - 1).to_bytes(2, "little") + body + tail)
    return b"".join(out)


def last_block() -> bytes:
    """The empty member that ends a block-gzip file."""
    head = _MAGIC + bytes([0, 0, 0, 0, 0, 255]) + (6).to_bytes(2, "little") + b"BC" + (2).to_bytes(2, "little")
    return head + (27).to_bytes(2, "little") + b"\x03\x00" + bytes(8)

