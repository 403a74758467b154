"""SimHash near-dedup against all pairs."""

import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from cellspark.llm import simhash


def brute_fingerprint(text, shingle=4):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def smallest_reachable(values, distance):
    """Value -> smallest value connected with it by links of at most ``distance`` bits."""
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_near_duplicates(table, request):
    df = request.getfixturevalue(table)
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in df.collect()]
    reach = smallest_reachable([f for _, f in rows], 4)
    least = {}
    for doc, value in rows:
        if doc is not None:
            least[reach[value]] = min(least.get(reach[value], doc), doc)
    expected = sorted((str(d), f"{v:016x}", least.get(reach[v])) for d, v in rows)
    found = simhash.near_duplicates(df)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in found.collect())
    assert got == expected
    if table == "documents":
        assert len({c for _, _, c in got}) < len(got)


def clustered(n, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    found = set()
    for _ in range(n):
        value = int(centres[rng.integers(0, 6)])
        for bit in rng.integers(0, 64, rng.integers(0, 6)):
            value ^= 1 << int(bit)
        found.add(value)
    return sorted(found | {int(x) for x in rng.integers(0, 1 << 63, 200, dtype=np.uint64)} | {0, (1 << 64) - 1})


@pytest.mark.parametrize(("segments", "block", "distance"), [(3, 2048, 4), (3, 40, 4), (2, 100, 4), (4, 64, 3), (5, 64, 4)])
def test_links_connect_all_near_pairs(spark, segments, block, distance):
    """Small blocks cut the crowded cells; no plan may lose a link."""
    values = clustered(400, segments)
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), distance, segments, block)
    unsigned = [(int(np.int64(r.a).view(np.uint64)), int(np.int64(r.b).view(np.uint64))) for r in links.collect()]
    assert all((a ^ b).bit_count() <= distance for a, b in unsigned)
    expected = smallest_reachable(values, distance)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in unsigned:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {v: find(v) for v in values} == expected
    spanning = {(r.node): r.root for r in simhash.components(links).collect()}
    by_root = {}
    for node, top in spanning.items():
        by_root.setdefault(top, set()).add(int(np.int64(node).view(np.uint64)))
    groups = {}
    for v, top in expected.items():
        groups.setdefault(top, set()).add(v)
    assert sorted(map(sorted, by_root.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_long_chain_settles(spark):
    links = spark.range(300).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in simhash.components(links).collect()} == {0}


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).count() == 0


def test_segment_plan_finds_every_pair():
    for distance in range(7):
        for segments in (1, 2, 3, 4, 5):
            plan = simhash.segment_plan(distance, segments)
            # every way to spread the differing bits over the segments has a searched one
            def spread(left, parts):
                if parts == 1:
                    yield (left,)
                    return
                for x in range(left + 1):
                    yield from ((x, *rest) for rest in spread(left - x, parts - 1))

            for bits in spread(distance, segments):
                assert any(b <= r for b, (_, _, r) in zip(bits, plan))
