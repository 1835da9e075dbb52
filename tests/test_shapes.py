"""Plan checks: what may shuffle, what runs outside the JVM, what is parsed twice."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks import fixtures as fx
from clinflat.operators import observation, stats, survey
from clinflat.operators.joins import left_lookup
from clinflat.operators.window import Window
from clinflat.session import stage
from clinflat.sources import resources
from test_resources import rows

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unnesting_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "r")
    fx.responses(spark, SF).unionByName(fx.observations(spark, SF)).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "Exchange" not in plan(survey.response_items(stored))
    text = plan(observation.measurements(stored))
    assert "Exchange" not in text
    # One parse per resource: no filter repeats it below the generator.
    assert text.count("from_json") == 1
    text = plan(survey.response_items(stored))
    assert sum("from_json(StructField(id" in line for line in text.split("\n")) == 1


def test_promoted_columns_give_the_same_results(spark, tmp_path):
    raw = fx.resources(spark, SF)
    resources.write_lake(raw, str(tmp_path))
    lake = resources.read_lake(spark, str(tmp_path))
    for result in (
        stats.coding_systems,
        survey.questionnaire_refs,
        lambda r: stats.temporal_coverage(r, "Observation"),
        lambda r: stats.temporal_coverage(r, "QuestionnaireResponse"),
        lambda r: resources.scan(r, "QuestionnaireResponse", Window("1997", "1998-03")).select("id"),
    ):
        assert rows(result(lake)) == rows(result(raw))
        text = plan(result(lake))
        assert "from_json" not in text and "json#" not in text


def test_used_questionnaires_is_a_semi_join(spark):
    refs = survey.questionnaire_refs(fx.responses(spark, SF))
    assert "LeftSemi" in plan(survey.used_questionnaires(fx.questionnaires(spark, SF), refs))


def test_small_map_is_broadcast_and_large_one_joined_without_copies(spark):
    observed, people = fx.observations(spark, SF), fx.patients(spark, SF)
    assert "BroadcastHashJoin" in plan(observation.long_observations(observed, people))
    large = plan(observation.long_observations(observed, people, limit=0))
    assert "pmod" in large and "explode(sequence" not in large and "Cartesian" not in large


@pytest.mark.parametrize("name", ["obs_long", "survey_long", "facet_triples", "metadata_violations", "folder_entries"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    for operator in ("PythonUDF", "ArrowEval", "BatchEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
        assert operator not in text


@pytest.mark.parametrize("name", ["metadata_sheet_pivot", "metadata_violations", "workbook_records"])
def test_large_sides_are_not_broadcast_by_a_wrong_estimate(spark, name):
    assert "BroadcastExchange" not in plan(contract.queries()[name](spark, SF))


def test_salted_survey_broadcasts_no_lookup(spark):
    lines = plan(contract.queries()["survey_long_salted"](spark, SF)).split("\n")
    assert not [x for x in lines if "BroadcastHashJoin" in x and "LeftOuter" in x]


def test_large_lookup_is_not_broadcast(spark):
    asked = survey.response_items(fx.responses(spark, SF))
    definitions = survey.flat_definitions(fx.questionnaires(spark, SF))
    assert "BroadcastExchange" not in plan(survey.join_texts(asked, definitions, limit=0))


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    path = tmp_path / "events.parquet"
    made = spark.range(0, 1_000_000, 1, 1).selectExpr("id AS event_id", "repeat(sha2(cast(id AS string), 256), 2) AS props")
    made.write.option("parquet.block.size", 1 << 30).parquet(str(path))
    events = fx.table(spark, str(tmp_path), "events")
    sizes = [r["count"] for r in events.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 1_000_000 and len(sizes) >= 8 and max(sizes) < 2 * fx.ROWS_A_TASK


def test_a_window_parses_dates_once(spark):
    found = resources.scan(fx.responses(spark, SF), "QuestionnaireResponse", Window("1997", "1998-03"))
    text = found.select("id")._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "try_to_timestamp" in line for line in text.split("\n"))


def test_cohort_statistics_parse_the_observations_once(spark):
    text = plan(contract.queries()["dataset_stats_cohort"](spark, SF))
    assert "effectiveDateTime" not in text


def test_numbers_are_rewritten_only_where_needed(spark):
    raw = spark.createDataFrame([], "resource_type string, id string, json string")
    text = plan(survey.response_items(raw))
    assert "RLIKE(json" in text


def test_rows_of_many_row_groups_are_not_shuffled(spark, tmp_path):
    path = tmp_path / "events.parquet"
    made = spark.range(0, 1_600_000, 1, 16).selectExpr("id AS event_id", "repeat(sha2(cast(id AS string), 256), 2) AS props")
    made.write.parquet(str(path))
    events = fx.table(spark, str(tmp_path), "events")
    assert "Exchange" not in plan(events) and events.count() == 1_600_000


def test_intermediate_tables_leave_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {b for b in manager.getAllBlocks().mkString(" ").split(" ") if b.startswith("shuffle_")}

    held = shuffled()
    made = stage(spark.range(100_000).groupBy(F.col("id") % 1000).count().toDF("k", "n"), "made")
    assert not shuffled() - held and spark.conf.get(setting) == before
    assert made.count() == 1000


def test_salted_survey_joins_twice_and_sorts_no_answers(spark):
    text = plan(contract.queries()["survey_long_salted"](spark, SF))
    final = text[text.rfind("Initial Plan") :] if "Initial Plan" in text else text
    assert "SortMergeJoin" not in [x.strip(" +-:*").split(" ")[0] for x in final.split("\n") if "LeftOuter" in x]
    assert sum("LeftOuter" in x for x in final.split("\n")) == 2


def test_rows_without_a_code_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "r")
    fx.responses(spark, SF).write.parquet(path)
    definitions = stage(survey.flat_definitions(fx.questionnaires(spark, SF)), "definitions")
    asked = survey.response_items(spark.read.parquet(path))
    joined = survey.join_options(asked, definitions, limit=0)
    text = plan(joined)
    assert text.count("ShuffledHashJoin") == 1 and "Union" in text
    small = survey.join_options(asked, definitions)
    assert rows(joined.select(sorted(joined.columns))) == rows(small.select(sorted(joined.columns)))
    texts = [survey.join_texts(asked, definitions, limit) for limit in (0, 1 << 25)]
    assert rows(texts[0].select(sorted(texts[0].columns))) == rows(texts[1].select(sorted(texts[0].columns)))


def test_a_lookup_too_large_for_memory_is_sorted(spark, monkeypatch):
    monkeypatch.setattr("clinflat.operators.joins.HASHED_BYTES", 0)
    facts = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, n int")
    lookup = spark.createDataFrame([("a", "A")], "k string, t string")
    found = left_lookup(facts, lookup, ["k"], limit=0)
    assert "SortMergeJoin" in plan(found)
    assert sorted(map(tuple, found.select("n", "t").collect())) == [(1, "A"), (2, None), (3, None)]
