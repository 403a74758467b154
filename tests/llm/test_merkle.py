"""Merkle manifest against a plain recursive tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cellspark.llm import merkle
from cellspark.llm.queries import op13_merkle_manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """(root, path of each leaf) by definition."""
    paths = [[] for _ in leaves]
    nodes = [(leaf, [i]) for i, leaf in enumerate(leaves)]
    while len(nodes) > 1:
        upper = []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append(("".join(d for d, _ in run[:k]), "".join(d for d, _ in run[k + 1 :])))
            upper.append((sha(*[d for d, _ in run]), [i for _, below in run for i in below]))
        nodes = upper
    return nodes[0][0], paths


def expected(rows):
    """rows: (group, order, leaf, tag) to (tag, subroot, root, path)."""
    groups = {}
    for group, order, leaf, tag in rows:
        groups.setdefault(group, []).append((order is not None, order or 0, leaf, tag))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots = {}
    for name in names:
        groups[name].sort()
        subroots[name] = tree([leaf for _, _, leaf, _ in groups[name]])
    root, tops = tree([subroots[name][0] for name in names])
    return sorted(
        (tag, subroots[name][0], root, subroots[name][1][i] + tops[k])
        for k, name in enumerate(names)
        for i, (_, _, _, tag) in enumerate(groups[name])
    )


def found(df):
    return sorted((r.tag, r.subroot, r.root, [tuple(level) for level in r.path]) for r in df.collect())


def run(spark, rows):
    df = spark.createDataFrame(rows, "grp string, o long, leaf string, tag long")
    return merkle.manifest(df, "leaf", "grp", ["o"])


def test_sizes_around_the_fanout(spark):
    rng = random.Random(1)
    rows, tag = [], 0
    for group, size in ((None, 9), ("", 1), ("a", 8), ("é", 64), ("z", 65), ("Z", 7), ("b", 200), ("aa", 2), ("k", 513), ("zz", 1)):
        for o in rng.sample(range(10_000), size):
            rows.append((group, o, sha(str(tag)), tag))
            tag += 1
    got = run(spark, rows)
    assert found(got) == expected(rows)
    assert got.filter(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0


@pytest.mark.parametrize("rows", [[("x", 5, sha("x"), 1)], [(None, None, sha("x"), 1)], [(str(i), 1, sha(str(i)), i) for i in range(20)]])
def test_lone_leaves(spark, rows):
    assert found(run(spark, rows)) == expected(rows)


def test_ties_and_nulls(spark):
    # equal rows may change places, so the tag is part of the leaf's identity here
    rows = [("g", o, sha(str(i)), i) for i, o in enumerate([3, None, 3, 1, None, 1, 3, 7, 7, None, 0, 0, 0])]
    assert found(run(spark, rows)) == expected(rows)


def test_no_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([("g", i, sha(str(i)), "a", "b", i) for i in range(9)], "grp string, o long, leaf string, root string, path string, n int")
    assert merkle.manifest(df.limit(0), "leaf", "grp", ["o"]).count() == 0
    got = merkle.manifest(df, "leaf", "grp", ["o"])
    assert got.columns == ["grp", "o", "leaf", "n", "subroot", "root", "path"]
    assert got.select("root").distinct().first()[0] == tree([sha(str(i)) for i in range(9)])[0]


def test_query_on_odd_documents(spark, odd, tmp_path):
    odd.withColumnRenamed("n_words", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    rows = [
        (r.lang, r.doc_id, sha(*[framed(v) for v in (r.doc_id, r.source, r.lang, r.n_words, r.text)]), i)
        for i, r in enumerate(odd.collect())
    ]
    want = expected(rows)
    table = {i: (r, leaf) for i, (r, (_, _, leaf, _)) in enumerate(zip(odd.collect(), rows))}
    got = op13_merkle_manifest(spark, str(tmp_path)).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lines = []
    for tag, subroot, root, path in want:
        r, leaf = table[tag]
        node = leaf
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
            text = None if r.text is None else r.text.translate(lower)
            node = sha(*[framed(v) for v in (r.doc_id, r.source, r.lang, r.n_words, text)])
        for before, after in path:
            node = sha(before, node, after)
        proof = sha("".join(b + a for b, a in path))
        lines.append((str(r.doc_id), leaf, subroot, root, proof, node, node == root))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(lines)
