"""Registered training-data queries against their SQL, and the contract of the others."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from cellspark.llm.oracle import ORACLE_SQL
from cellspark.llm.queries import QUERIES
from check_queries import compare

from .conftest import SF


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    _, same, rows, note = compare(spark, con, name, SF)
    assert same, note
    assert rows > 0


def test_all_are_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in QUERIES) == 1 for n in names)
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert set(ORACLE_SQL) <= set(entry_module.oracle_sql())


COLUMNS = {
    "op1_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op2_best_fit_packing": {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op3_sharding": {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
        "grown_shard": "int",
    },
    "op12_harmonic_packing": {
        "doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint",
        "sequence_id": "bigint", "offset": "bigint",
    },
    "op10_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, documents, name):
    found = QUERIES[name](spark, SF)
    assert dict(found.dtypes).items() >= COLUMNS[name].items()
    assert found.select("doc_id").distinct().count() == documents.count()
