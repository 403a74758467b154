"""A sample of the registered queries against their SQL; ``check_queries.py`` runs all of them."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from cellspark import registry
from check_queries import compare
from oracle_queries import ORACLE_SQL

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "correction_list", "qc_cascade", "qc_reads", "quality_curve", "gene_models", "region_bases", "assign_exons",
    "annotated_alignments", "dedup_stats", "count_matrix", "cells_single", "cells_mixed", "distribution_percent", "metrics_pivot",
]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_registry_is_complete():
    assert set(registry.QUERIES) == set(ORACLE_SQL)
    assert set(registry.QUERIES) <= set(entry_module.queries())
    assert set(ORACLE_SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["sample", "barcode", "total_counts", "n_genes", "threshold", "is_single_cell"]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, con, name):
    _, same, rows, note = compare(spark, con, name, SF)
    assert same, note
    assert rows > 0
