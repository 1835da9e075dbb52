"""Sparse profiles and changes between graphs."""

from clinflat.operators import graph_delta as gd
from clinflat.operators import profile
from clinflat.operators.triples import TRIPLE_COLUMNS

LONG = "pid string, code string, value string, date string"
TRIPLE = ", ".join(f"{c} string" for c in TRIPLE_COLUMNS)


def test_sparse_profile_of_very_many_codes(spark):
    data = spark.range(0, 200_000, 1, 8).selectExpr(
        "CASE WHEN id % 5 < 2 THEN 'often' ELSE 'p' || (id % 97) END AS pid",
        "'c' || (id * 7919 % 20000) AS code", "CAST(id % 13 AS STRING) AS value",
        "CASE WHEN id % 3 = 0 THEN '2020-01-' || (10 + id % 20) END AS date",
    )
    sparse = profile.sparse_profiles(data)
    text = sparse._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") <= 2
    assert sparse.selectExpr("sum(size(metrics)) AS n").first()["n"] == data.select("pid", "code").distinct().count()
    some = ["c1", "c77", "c19999", "absent"]
    wide = sorted(map(tuple, profile.patient_profiles(data, some).collect()))
    assert sorted(map(tuple, profile.metric_columns(sparse, some).collect())) == wide


def test_sparse_profile_edge_cases(spark):
    data = spark.createDataFrame(
        [("a", "x", "late", "2021"), ("a", "x", "early", "2020"), ("a", "x", "undated", None),
         ("a", None, "v", "2020"), ("b", None, "v", None), (None, "x", "1", None), ("c", "x", None, "2020")], LONG)
    got = {r["pid"]: r["metrics"] for r in profile.sparse_profiles(data).collect()}
    assert got == {"a": {"x": "early"}, "b": {}, None: {"x": "1"}}
    assert profile.sparse_profiles(data.limit(0)).count() == 0


def _graph(spark, *triples):
    return spark.createDataFrame([(*t, *[None] * (6 - len(t))) for t in triples], TRIPLE)


def test_delta_gives_the_new_graph(spark):
    same = ("s", "p", "o", "uri")
    # The same text as a datatype and as a language are two triples.
    typed, spoken = ("s", "p", "o", "literal", "en", None), ("s", "p", "o", "literal", None, "en")
    old = _graph(spark, same, same, typed, ("gone", "p", "o", "uri"), ("gone", "p", "o", "uri"))
    new = _graph(spark, same, spoken, ("come", "p", "o", "uri"), ("come", "p", "o", "uri"))
    delta = gd.graph_delta(old, new)
    ops = sorted((r["op"], r["s"], r["datatype"] or "", r["lang"] or "") for r in delta.collect())
    assert ops == [("add", "come", "", ""), ("add", "s", "", "en"), ("drop", "gone", "", ""), ("drop", "s", "en", "")]
    once = gd.apply_delta(old, delta)
    assert set(map(tuple, once.collect())) == set(map(tuple, new.collect()))
    assert set(map(tuple, gd.apply_delta(once, delta).collect())) == set(map(tuple, new.collect()))


def test_delta_of_equal_and_empty_graphs(spark):
    graph, none = _graph(spark, ("s", "p", "o", "uri")), _graph(spark, ("s", "p", "o", "uri")).limit(0)
    assert gd.graph_delta(graph, graph).count() == 0
    assert [r["op"] for r in gd.graph_delta(none, graph).collect()] == ["add"]
    assert [r["op"] for r in gd.graph_delta(graph, none).collect()] == ["drop"]
    assert gd.apply_delta(graph, gd.graph_delta(graph, none)).count() == 0
