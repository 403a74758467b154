"""Two-pass shuffle: every row once, equal counts, gapless slots, one order for one seed."""

from collections import Counter

import numpy as np

from cellspark.llm import sharding


def placed(df, **options):
    return sharding.shard(df, **options).collect()


def check(rows, given, shards):
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in given)
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(counts) <= set(range(shards))
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_documents(documents):
    given = documents.collect()
    for bucket in (16 << 20, 20_000):
        rows = placed(documents, bucket_bytes=bucket)
        check(rows, given, 40)
    again = placed(documents.repartition(3), bucket_bytes=20_000)
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in rows}
    other = placed(documents, bucket_bytes=20_000, seed=1)
    check(other, given, 40)
    assert {(r.doc_id, r.shard) for r in other} != {(r.doc_id, r.shard) for r in rows}


def test_odd(odd, spark):
    clash = odd.withColumnRenamed("source", "slot")
    rows = sharding.shard(clash, shards=4)
    assert sorted(rows.columns) == sorted([c for c in clash.columns if c != "slot"] + ["slot", "shard"])
    check(rows.collect(), odd.collect(), 4)
    check(placed(odd, shards=40), odd.collect(), 40)  # fewer rows than shards


def test_empty(nothing):
    assert sharding.shard(nothing).count() == 0


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(sharding.fisher_yates(3, seed)) for seed in range(6000))
    assert len(seen) == 6 and min(seen.values()) > 850
    assert sharding.fisher_yates(0, 1).tolist() == []
    assert sorted(sharding.fisher_yates(100, 1)) == list(range(100))
    assert (sharding.fisher_yates(100, 1) == sharding.fisher_yates(100, 1)).all() and isinstance(
        sharding.fisher_yates(5, 2), np.ndarray
    )
