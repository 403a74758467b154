"""Split reading of FASTQ lanes against a plain reader, over all kinds of files and split sizes."""

import gzip
import random

import pytest

from cellspark.sources import fastq, splits


def plain_pairs(one: bytes, two: bytes):
    """Records of two texts by definition."""

    def records(data):
        lines = data.decode("ascii", "replace").split("\n")
        if lines[-1] == "":
            lines.pop()
        for at in range(0, len(lines), 4):
            four = [x.rstrip("\r\n") for x in lines[at : at + 4]]
            four += [""] * (4 - len(four))
            yield four[0], four[1], four[3]

    left, right = list(records(one)), list(records(two))
    right += [("", "", "")] * (len(left) - len(right))
    return [(i, *a, *b[1:]) for i, (a, b) in enumerate(zip(left, right))]


def text_of(n, seed, width=90):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        length = rng.randrange(1, width)
        # qualities that look like headers, and empty sequences
        quality = "@" + "".join(chr(rng.randrange(33, 74)) for _ in range(length - 1))
        out.append(f"@r{i} x\n{'ACGT' * (length // 4) if length % 7 else ''}\n+{'@' if i % 5 == 0 else ''}\n{quality}\n")
    return "".join(out).encode()


def blocked(data, sizes):
    """Block-gzip file with members of odd sizes, empty ones among them."""
    out, at = [], 0
    while at < len(data):
        size = sizes[len(out) % len(sizes)]
        out.append(splits.pack_blocks(data[at : at + size]) if size else splits.last_block())
        at += size
    return b"".join(out) + splits.last_block()


def write(path, data, kind):
    if kind == "blocks":
        data = blocked(data, [700, 1, 0, 2500, 64])
    elif kind == "gzip":
        half = len(data) // 2
        data = gzip.compress(data[:half]) + gzip.compress(data[half:])
    elif kind == "mixed":  # begins like a block-gzip file and goes on as another one
        data = blocked(data[:3000], [900]) + gzip.compress(data[3000:])
    path.write_bytes(data)
    return str(path)


ONE = text_of(400, 1)
CASES = {
    "even": (ONE, text_of(400, 2, 14)),
    "short mates": (ONE, text_of(150, 3)),
    "long mates": (text_of(90, 4), ONE),
    "cut record": (ONE[: len(ONE) // 2 + 3], text_of(400, 5)),
    "cut mates": (ONE, text_of(400, 6)[:9001]),
    "no last line end": (ONE[:-1], text_of(400, 7)[:-1]),
    "windows line ends": (ONE.replace(b"\n", b"\r\n"), text_of(400, 8)),
    "strange bytes": (ONE.replace(b"A", b"\xc3\xa9"), text_of(400, 9)),
    "one long line": (b"@x\n" + b"A" * 30_000 + b"\n+\n" + b"I" * 30_000 + b"\n" + text_of(5, 10), text_of(3, 11)),
    "no mates": (text_of(9, 12), b""),
    "no reads": (b"", text_of(9, 13)),
    "empty lines": (b"\n" * 4001, b"\n" * 17),
}


@pytest.mark.parametrize("split_bytes", [1700, 1 << 26])
@pytest.mark.parametrize("kinds", [("plain", "blocks"), ("blocks", "plain"), ("blocks", "blocks"), ("plain", "mixed"), ("gzip", "plain")])
def test_lanes_equal_a_plain_reader(spark, tmp_path, kinds, split_bytes):
    sheet, want = [], {}
    for lane, (one, two) in enumerate(CASES.values()):
        paths = [write(tmp_path / f"{lane}_{m}.fq", data, kind) for m, (data, kind) in enumerate(zip((one, two), kinds))]
        sheet.append(("S", lane, *paths))
        want[lane] = plain_pairs(one, two)
    df = spark.createDataFrame(sheet, "sample string, lane int, fastq_1 string, fastq_2 string")
    rows = fastq.read_fastq_pairs(spark, df, split_bytes=split_bytes)
    got = {lane: [] for lane in want}
    for r in rows.collect():
        got[r.lane].append((r.ord, r.header, r.r1_seq, r.r1_qual, r.r2_seq, r.r2_qual))
    for lane, name in enumerate(CASES):
        assert sorted(got[lane]) == want[lane], name
    if kinds == ("blocks", "blocks") and split_bytes == 1700:
        assert rows.rdd.getNumPartitions() > 60


def test_merged_lanes_and_a_kept_index(spark, tmp_path):
    kinds = ["plain", "gzip", "blocks", "plain"]
    lanes = [text_of(n, n) for n in (50, 7, 120, 0)]
    rows = [("B", 3 - i, *[write(tmp_path / f"{i}{m}", data, kind) for m in "ab"]) for i, (kind, data) in enumerate(zip(kinds, lanes))]
    rows.append(("A", 1, *rows[0][2:]))
    sheet = spark.createDataFrame(rows, "sample string, lane int, fastq_1 string, fastq_2 string")
    index = splits.line_index(spark, [p for r in rows for p in r[2:]], 400)
    splits.write_index(index, str(tmp_path / "index"))
    kept = splits.read_index(spark, str(tmp_path / "index"))
    found = fastq.read_fastq_pairs(spark, sheet, merged=True, index=kept)
    got = sorted((r["sample"], r.ord, r.header) for r in found.collect())
    whole = plain_pairs(b"".join(reversed(lanes)), b"")
    assert got == sorted([("B", o, h) for o, h, *_ in whole] + [("A", o, h) for o, h, *_ in plain_pairs(lanes[0], b"")])


def test_no_lanes_and_lost_files(spark, tmp_path):
    sheet = spark.createDataFrame([], "sample string, lane int, fastq_1 string, fastq_2 string")
    assert fastq.read_fastq_pairs(spark, sheet).count() == 0
    data = blocked(ONE, [700])
    (tmp_path / "cut.gz").write_bytes(data[: len(data) // 2])
    cut = spark.createDataFrame([("S", 1, str(tmp_path / "cut.gz"), str(tmp_path / "cut.gz"))], sheet.schema)
    with pytest.raises(Exception, match="EOF|end-of-stream|ended before"):
        fastq.read_fastq_pairs(spark, cut, split_bytes=5000).count()


def test_blocks_are_gzip():
    data = bytes(random.Random(1).randbytes(200_000)) + b"A" * 100_000
    assert gzip.decompress(splits.pack_blocks(data) + splits.last_block()) == data


def test_members_are_read_wherever_the_buffer_ends(monkeypatch, tmp_path):
    import pyarrow as pa

    text = text_of(4000, 7)
    path = tmp_path / "lane.fastq.gz"
    path.write_bytes(b"".join(splits.pack_blocks(text[i : i + 900]) for i in range(0, len(text), 900)) + splits.last_block())
    size = path.stat().st_size
    # refills within every few members, so that some fall into a member's header
    monkeypatch.setattr(splits, "BUFFER", 1000)
    rows = [{"path": str(path), "kind": splits.BLOCKS, "start": at, "end": min(at + 50_000, size), "size": size} for at in range(0, size, 50_000)]
    found = [r for batch in splits._count([pa.RecordBatch.from_pylist(rows)]) for r in batch.to_pylist()]
    assert not any(r["broken"] for r in found)
    assert sum(r["ends"] for r in found) == text.count(b"\n") and sum(r["bytes"] for r in found) == len(text)


def test_batches_of_records_keep_mates_and_line_ends(monkeypatch, tmp_path):
    monkeypatch.setattr(fastq, "BATCH", 3)
    lines = [[f"@{m}{i} x", "ACGT"[i % 4] * (i + 1), "+", "I" * (i + 1)] for m in "ab" for i in range(8)]
    one, two = ["\r\n".join(sum(lines[:8], [])) + "\r\n", "\n".join(sum(lines[8:12], []))]
    for name, text in (("r1", one), ("r2", two)):
        (tmp_path / name).write_bytes(text.encode())
    mates = [[str(tmp_path / name), splits.PLAIN, 0, 0, 0] for name in ("r1", "r2")]
    for last in (8, None):
        reader = fastq.FastqPairReader({"lanes": "[]"})
        batches = list(reader.read(fastq.LaneSplit("S", 1, 0, last, *mates)))
        assert [b.num_rows for b in batches] == [3, 3, 2]
        got = [tuple(r.values())[2:] for b in batches for r in b.to_pylist()]
        assert got == plain_batch(one, two)


def plain_batch(one: str, two: str):
    return [tuple(r) for r in plain_pairs(one.encode(), two.encode())]


def test_writer_takes_the_bytes_of_each_files_rows():
    import pyarrow as pa

    from cellspark.sources import single_file

    files = pa.array(["a", "a", "b", "b", "b", "c"])
    values = pa.array(["x\n", "é\n", "", "long\nline\n", "z\n", "w\n"])
    for skip in (0, 1, 3):
        at, found = 0, []
        for file, end in single_file._runs(files.slice(skip)):
            found.append((file, b"".join(single_file._pieces(values.slice(skip), at, end)).decode()))
            at = end
        want = {}
        for file, value in list(zip(files.to_pylist(), values.to_pylist()))[skip:]:
            want[file] = want.get(file, "") + value
        assert found == list(want.items())
