"""Queries that write intermediate tables, on a cluster whose checkpoint folder is a mount."""

import pytest

import __spark_entry__ as contract

# Twelve rows each; every key refers to a row that exists.
TABLES = {
    "customer": "id c_custkey, concat('c', id) c_name, int(id % 3) c_nationkey",
    "supplier": "id s_suppkey, concat('s', id) s_name, int(id % 3) s_nationkey, 1.5D s_acctbal",
    "part": "id p_partkey, concat('part ', id) p_name, concat('Brand#', id) p_brand, "
    "'TYPE' p_type, int(id) p_size, id + 0.25D p_retailprice",
    "orders": "id o_orderkey, id o_custkey, 'O' o_orderstatus, id + 0.5D o_totalprice, "
    "timestamp'1996-03-04' o_orderdate, '1-URGENT' o_orderpriority",
    "lineitem": "id l_orderkey, id l_partkey, id l_suppkey, int(1) l_linenumber, 20D l_quantity, "
    "id + 0.5D l_extendedprice, 0.1D l_discount, 0.1D l_tax, 'N' l_returnflag, 'O' l_linestatus, "
    "timestamp'1996-05-06' l_shipdate",
    "events": "id event_id, timestamp'2024-01-02' ts, id user_id, 'click' event_type, "
    "id + 0.5D value, '{\"k\": 7}' props",
}
STAGING = (
    "column_vocab_links",
    "dict_csv_scan",
    "entries_roundtrip",
    "full_long",
    "graph_delta",
    "graph_republished",
    "sink_csv_roundtrip",
    "sink_parquet_roundtrip",
    "skos_triples",
    "stats_from_states",
    "survey_long",
    "survey_stats",
    "systems_from_states",
    "temporal_coverage_full",
    "vocab_from_states",
    "vocab_merged",
    "vocab_question",
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    for name, columns in TABLES.items():
        spark.sql(f"SELECT {columns} FROM range(1, 13)").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", STAGING)
def test_staging_query_runs_on_a_cluster(spark, tables, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert contract.queries()[name](spark, tables).count() > 0
