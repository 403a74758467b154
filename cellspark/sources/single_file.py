"""Ordered text outputs as one file each, committed in two phases.

Spark's writers make a folder of part files; tools downstream want one ``matrix.mtx.gz``. Here rows are range-partitioned
by file and order, and every task writes the part of each file that its range holds, packed in block-gzip members (or
plain), into a staging folder, under a name that no other attempt has. The driver's commit lists the parts of the tasks
that won, in the order of their ranges. Then one task per file joins its parts, which needs no unpacking since members
may follow each other, and the driver moves the whole files into place. A failed or killed task leaves only the staging
folder, which abort removes; a file in place is whole.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from cellspark.session import ship
from cellspark.sources.splits import last_block, pack_blocks

#: Uncompressed bytes that a writer packs at once, and bytes that a joining task copies at once.
CHUNK = 4 << 20
#: Rows whose bytes a writer takes at once.
STEP = 2000
MANIFEST = "manifest.json"


def file_system(path: str):
    """(file system, path on it) for any store that Arrow knows."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


@dataclass
class Parts(WriterCommitMessage):
    """(file, number of the range, path in the staging folder, bytes) of one task."""

    parts: list


def _runs(column) -> list[tuple]:
    """(value, index after its last row) of each run of equal values."""
    import pyarrow.compute as pc

    if not len(column):
        return []
    runs = pc.run_end_encode(column)
    return list(zip(runs.values.to_pylist(), runs.run_ends.to_pylist()))


def _pieces(column, start: int, end: int):
    """The bytes of a column's values from row ``start`` to ``end``, as they lie in memory, ``STEP`` rows at a time."""
    for at in range(start, end, STEP):
        some = column.slice(at, min(STEP, end - at)).cast("large_string")
        _, offsets, data = some.buffers()
        bounds = memoryview(offsets).cast("q")
        yield bytes(memoryview(data)[bounds[some.offset] : bounds[some.offset + len(some)]]) if data is not None else b""


class PartsWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.staging, self.packed = options["staging"], options["packed"] == "true"

    def write(self, iterator):
        context = TaskContext.get()
        system, root = file_system(self.staging)
        system.create_dir(root, recursive=True)
        parts, current, out, held, size = [], None, None, [], 0

        def flush():
            nonlocal size
            data = b"".join(held)
            held.clear()
            size = 0
            out.write(pack_blocks(data) if self.packed else data)

        def close():
            if out is not None:
                flush()
                parts[-1][3] = out.tell()
                out.close()

        for batch in iterator:
            at = 0
            for file, end in _runs(batch.column(0)):
                if file != current:
                    close()
                    name = f"{root}/{context.partitionId()}-{context.taskAttemptId()}-{len(parts)}"
                    out, current = system.open_output_stream(name), file
                    parts.append([file, context.partitionId(), name, 0])
                for data in _pieces(batch.column(1), at, end):
                    held.append(data)
                    size += len(data)
                    if size >= CHUNK:
                        flush()
                at = end
        close()
        return Parts(parts)

    def commit(self, messages):
        system, root = file_system(self.staging)
        system.create_dir(root, recursive=True)
        listed = [part for message in messages if message is not None for part in message.parts]
        with system.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(sorted(listed)).encode())

    def abort(self, messages):
        remove(self.staging)


class PartsSource(DataSource):
    @classmethod
    def name(cls):
        return "ordered_file_parts"

    def schema(self):
        return "file string, value string"

    def writer(self, schema, overwrite):
        return PartsWriter(self.options)


def remove(path: str) -> None:
    from pyarrow import fs

    system, root = file_system(path)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)


def _join(staging: str, packed: bool):
    def run(batches):
        import pyarrow as pa

        context = TaskContext.get()
        system, root = file_system(staging)
        for batch in batches:
            done = []
            for file, parts, number in zip(*(c.to_pylist() for c in batch.columns)):
                name = f"{root}/whole-{number}-{context.taskAttemptId()}"
                with system.open_output_stream(name) as out:
                    for part in parts:
                        with system.open_input_stream(part) as data:
                            while piece := data.read(CHUNK):
                                out.write(piece)
                    if packed:
                        out.write(last_block())
                    done.append((file, name, out.tell()))
            columns = [pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.string(), pa.int64()))] if done else []
            if done:
                yield pa.RecordBatch.from_arrays(columns, ["file", "name", "bytes"])

    return run


def write_files(lines: DataFrame, order: list[str | Column], path: str, packed: bool = True) -> dict[str, int]:
    """Write each ``file`` of ``lines`` (file, value and what ``order`` names) as one file under ``path``.

    Returns the files' sizes. Values are a line each, or several with line ends between. Null files or values are
    refused. Files that exist are replaced; a file without lines is not made. ``packed``: block-gzip, which any gzip
    reader reads, and which readers of this package read in splits.
    """
    spark = lines.sparkSession
    ship(spark)
    spark.dataSource.register(PartsSource)
    staging = f"{path.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    sound = lines.select(
        F.coalesce("file", F.raise_error(F.lit("a file name is null"))).alias("file"),
        F.coalesce("value", F.raise_error(F.lit("a line is null"))).alias("value"),
        *[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)],
    )
    keys = ["file", *[f"_o{i}" for i in range(len(order))]]
    ranged = sound.repartitionByRange(*keys).sortWithinPartitions(*keys).select("file", F.concat("value", F.lit("\n")).alias("value"))
    try:
        writer = ranged.write.format("ordered_file_parts").mode("append")
        writer.option("staging", staging).option("packed", "true" if packed else "false").save()
        system, root = file_system(staging)
        with system.open_input_stream(f"{root}/{MANIFEST}") as file:
            parts = json.loads(file.read())
        by_file: dict[str, list] = {}
        for name, number, part, size in parts:
            by_file.setdefault(name, []).append((number, part))
        if not by_file:
            return {}
        jobs = [(name, [p for _, p in sorted(found)], i) for i, (name, found) in enumerate(sorted(by_file.items()))]
        todo = spark.createDataFrame(jobs, "file string, parts array<string>, number long").repartition(min(len(jobs), 1000))
        whole = todo.mapInArrow(_join(staging, packed), "file string, name string, bytes long").collect()
        _, target = file_system(path.rstrip("/"))
        for row in whole:
            place = f"{target}/{row['file']}"
            system.create_dir(place.rsplit("/", 1)[0], recursive=True)
            system.move(row["name"], place)
        return {row["file"]: row["bytes"] for row in whole}
    finally:
        remove(staging)
