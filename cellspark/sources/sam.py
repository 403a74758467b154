"""SAM text as a Spark data source that reads in splits, filters early and parses only what is asked.

Plain and block-gzip files are cut into byte ranges; ordinary gzip is one task. A split owns the lines that begin after
its first line end, up to and including the one that begins at its end, as line readers commonly do. Filters on the
mandatory fields are pushed to the scan: those on the sample leave out whole files, the others are applied to the split
text of a batch of lines before any other field or tag of them is looked at. Lines are handled in Arrow arrays, never
one by one.
"""

from __future__ import annotations

import json
import operator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cellspark.session import ship
from cellspark.sources import splits

#: Mandatory fields: place in the line and type.
FIELDS = {
    "read_name": (0, "string"), "flag": (1, "int"), "chrom": (2, "string"), "pos": (3, "long"), "mapq": (4, "int"),
    "cigar": (5, "string"), "seq": (9, "string"), "qual": (10, "string"),
}
#: Optional fields by name: tag, kind in the line, type.
TAGS = {
    "nh": ("NH", "i", "int"), "hi": ("HI", "i", "int"), "as": ("AS", "i", "int"), "nm": ("nM", "i", "int"),
    "xs": ("XS", "Z", "string"), "xn": ("XN", "i", "int"), "xt": ("XT", "Z", "string"),
}
COLUMNS = ("sample", *FIELDS, *TAGS)
#: Conditions and their Arrow functions.
COMPARE = {"=": "equal", "<": "less", "<=": "less_equal", ">": "greater", ">=": "greater_equal"}
_PLAIN = {"=": operator.eq, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


class TextSplit(InputPartition):
    def __init__(self, sample: str, path: str, kind: str, start: int, end: int, size: int):
        self.sample, self.path, self.kind, self.start, self.end, self.size = sample, path, kind, start, end, size


def line_batches(split: TextSplit):
    """The split's lines in buffers that end with a line end."""
    own, rest = b"", b""
    if split.kind == splits.STREAM:
        with splits.lines_from(split.path, split.kind, 0, 0) as text:
            while data := text.read(splits.BUFFER):
                data = rest + data
                cut = data.rfind(b"\n") + 1
                rest = data[cut:]
                if cut:
                    yield data[:cut]
        if rest:
            yield rest + b"\n"
        return
    skipping = split.start > 0
    held: list[bytes] = []
    held_size = 0
    for _, data in splits._stretches(split.path, split.kind, split.start, split.end, split.size):
        if skipping:
            found = data.find(b"\n")
            if found < 0:
                continue
            data, skipping = data[found + 1 :], False
        held.append(data)
        held_size += len(data)
        if held_size >= splits.BUFFER:
            own = b"".join(held)
            cut = own.rfind(b"\n") + 1
            held, held_size = [own[cut:]], len(own) - cut
            if cut:
                yield own[:cut]
    if skipping:
        return
    # the line that goes on behind the split, or begins right there
    for _, data in splits._stretches(split.path, split.kind, split.end, split.size, split.size) if split.end < split.size else ():
        found = data.find(b"\n")
        held.append(data if found < 0 else data[: found + 1])
        if found >= 0:
            break
    last = b"".join(held)
    if last:
        yield last if last.endswith(b"\n") else last + b"\n"


def _lines(data: bytes):
    """Arrow array of the lines of a buffer, without line ends, headers and blanks."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not data.isascii():
        data = data.decode("utf-8", "replace").encode()
    if b"\r" in data:
        data = data.replace(b"\r\n", b"\n")
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10).astype(np.int64)
    offsets = np.concatenate([[0], ends + 1])
    lines = pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    lines = pc.utf8_replace_slice(lines, -1, 1 << 40, "") if len(lines) else lines  # the line end
    return lines.filter(pc.and_(pc.not_equal(lines, ""), pc.invert(pc.starts_with(lines, "@"))))


class SamReader(DataSourceReader):
    def __init__(self, options):
        self.columns = json.loads(options["columns"])
        self.files = json.loads(options["files"])
        self.split_bytes = int(options["split_bytes"])
        self.filters = [tuple(one) for one in json.loads(options["where"])]

    def partitions(self):
        found = []
        for sample, path, kind, size in self.files:
            if all(self._holds(sample, how, value) for column, how, value in self.filters if column == "sample"):
                step = self.split_bytes if kind != splits.STREAM else max(size, 1)
                found += [TextSplit(sample, path, kind, at, min(at + step, size), size) for at in range(0, size, step)]
        return found or [TextSplit("", "", "none", 0, 0, 0)]

    @staticmethod
    def _holds(sample: str, how: str, value) -> bool:
        if how == "in":
            return sample in value
        # as UTF-8 bytes, the order that Spark has
        return _PLAIN[how](sample.encode(), value.encode())

    def read(self, partition: TextSplit):
        import pyarrow as pa
        import pyarrow.compute as pc

        if partition.kind == "none":
            return
        types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
        filters = [f for f in self.filters if f[0] != "sample"]
        needed = [FIELDS[c][0] for c in [*self.columns, *[f[0] for f in filters]] if c in FIELDS]
        deepest = max(needed, default=-1) + 1
        early = max([FIELDS[f[0]][0] for f in filters], default=-1) + 1

        def field(parts, column):
            place, kind = FIELDS[column]
            return pc.cast(pc.list_element(parts, place), types[kind])

        for data in line_batches(partition):
            lines = _lines(data)
            if filters and len(lines):
                parts = pc.split_pattern(lines, "\t", max_splits=early)
                keep = None
                for column, how, value in filters:
                    values = field(parts, column)
                    if how == "in":
                        one = pc.is_in(values, pa.array(value, values.type))
                    else:
                        one = pc.call_function(COMPARE[how], [values, pa.scalar(value, values.type)])
                    keep = one if keep is None else pc.and_(keep, one)
                lines = lines.filter(keep)
            if not len(lines):
                continue
            parts = pc.split_pattern(lines, "\t", max_splits=deepest) if deepest else None
            arrays = []
            for column in self.columns:
                if column == "sample":
                    arrays.append(pa.array([partition.sample] * len(lines), pa.string()))
                elif column in FIELDS:
                    arrays.append(field(parts, column))
                else:
                    tag, letter, kind = TAGS[column]
                    values = pc.struct_field(pc.extract_regex(lines, f"\t{tag}:{letter}:(?P<v>[^\t]*)"), "v")
                    values = pc.if_else(pc.equal(values, ""), pa.scalar(None, values.type), values)
                    arrays.append(pc.cast(values, types[kind]))
            yield pa.RecordBatch.from_arrays(arrays, self.columns)


class SamSource(DataSource):
    @classmethod
    def name(cls):
        return "sam_lines"

    def schema(self):
        kinds = {"sample": "string"} | {c: k for c, (_, k) in FIELDS.items()} | {c: k for c, (_, _, k) in TAGS.items()}
        return ", ".join(f"`{c}` {kinds[c]}" for c in json.loads(self.options["columns"]))

    def reader(self, schema):
        return SamReader(self.options)


def _describe(batches):
    import pyarrow as pa

    for batch in batches:
        rows = [(s, p, *splits.kind_of(p)) for s, p in zip(*(c.to_pylist() for c in batch.columns))]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.string(), pa.int64()))] if rows else []
        if rows:
            yield pa.RecordBatch.from_arrays(columns, ["sample", "path", "kind", "size"])


def scan_alignments(
    spark: SparkSession,
    files: DataFrame,
    columns: list[str] | None = None,
    where: list[tuple] = (),
    split_bytes: int = splits.SPLIT_BYTES,
) -> DataFrame:
    """Alignment rows of SAM files (``sample, path``), one task per split.

    ``columns`` are those that are parsed, all by default. ``where`` lists conditions that all have to hold:
    (column, one of = < <= > >= or in, constant or list of constants), of the sample and the mandatory fields; texts
    compare by their bytes. Header lines and blanks are left out; a line with fewer fields than are asked for is an
    error. One row per file passes through the driver.
    """
    ship(spark)
    spark.dataSource.register(SamSource)
    for column, how, value in where:
        given = value if how == "in" else [value]
        kind = int if FIELDS.get(column, (0, "string"))[1] != "string" else str
        if (column != "sample" and column not in FIELDS) or (how != "in" and how not in COMPARE):
            raise ValueError(f"no such condition: {column} {how}")
        if not all(type(v) is kind for v in given):
            raise ValueError(f"{column} has to be compared with {kind.__name__}")
    wanted = [c for c in COLUMNS if columns is None or c in columns]
    if columns is not None and set(columns) - set(COLUMNS):
        raise ValueError(f"no such columns: {sorted(set(columns) - set(COLUMNS))}")
    found = files.select("sample", "path").repartition(64).mapInArrow(_describe, "sample string, path string, kind string, size long")
    listed = sorted(map(tuple, found.collect()))
    reader = spark.read.format("sam_lines").option("columns", json.dumps(wanted)).option("files", json.dumps(listed))
    return reader.option("where", json.dumps(list(where))).option("split_bytes", str(split_bytes)).load()
