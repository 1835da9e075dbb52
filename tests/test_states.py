"""Mergeable statistics, and resources that arrive in steps."""

import json

import pytest
from pyspark.sql import functions as F

from clinflat.operators import observation, states, stats, vocab
from clinflat.sources import resources
from clinflat.streaming import arrival


def documents(first, n):
    """Patients and observations of several months, with awkward ones among them."""
    out = []
    for k in range(first, first + n):
        birth = {0: "19x0", 1: "1950"}.get(k % 7, f"{1940 + k % 50}-02-03")
        out.append({"resourceType": "Patient", "id": f"p{k}", "birthDate": birth,
                    "identifier": [{"system": f"http:\\/ids/{k % 3}", "value": f"v{k}"}]})
        date = {0: None, 1: "2024", 2: "bad"}.get(k % 9, f"2024-{1 + k % 5:02d}-11T10:00:00Z")
        coding = {"system": "http://codes", "code": f"c{k % 4}", "display": f"name {k % 6}"}
        out.append({"resourceType": "Observation", "id": f"o{k}", "effectiveDateTime": date,
                    "subject": {"reference": f"Patient/p{k // 2}"} if k % 11 else None,
                    "code": {"coding": [coding if k % 8 else {"code": "bare"}]}, "valueInteger": k})
    return [{a: b for a, b in d.items() if b is not None} for d in out]


def frame(spark, docs):
    rows = [(d["resourceType"], d["id"], json.dumps(d)) for d in docs]
    return spark.createDataFrame(rows, "resource_type string, id string, json string")


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def all_states(lake):
    month = F.coalesce(F.substring("date", 1, 7), F.lit("undated"))
    patients = resources.of_type(lake, "Patient")
    rows = observation.long_observations(resources.of_type(lake, "Observation"), patients)
    return states.row_states(rows, month).unionByName(states.resource_states(lake, month))


def test_states_of_parts_give_the_statistics_of_all(spark, tmp_path):
    raw = frame(spark, documents(0, 90))
    resources.write_lake(raw, str(tmp_path / "lake"))
    lake = resources.read_lake(spark, str(tmp_path / "lake"))
    states.write_states(all_states(lake), str(tmp_path / "states"))
    state = states.merged(states.read_states(spark, str(tmp_path / "states")))

    patients = resources.of_type(lake, "Patient")
    observed = resources.of_type(lake, "Observation")
    rows = observation.long_observations(observed, patients)
    coverage = stats.temporal_coverage(observed, "Observation")
    want = stats.dataset_stats(rows, patients, coverage, 2026)
    got = states.statistics(state, "Observation", 2026)
    assert collected(got) == collected(want) and got.columns == want.columns
    assert collected(states.vocabulary(state, "x")) == collected(vocab.code_vocabulary(rows, "x"))
    assert collected(states.systems(state)) == collected(stats.coding_systems(lake))
    assert collected(states.type_counts(state)) == collected(stats.resource_counts(lake))


def test_no_data(spark, tmp_path):
    none = resources.with_promoted(frame(spark, documents(0, 1)).limit(0))
    state = states.merged(all_states(none))
    assert collected(states.statistics(state, "Observation", 2026)) == [(0, 0, 0, 0, None, None)]
    assert collected(states.systems(state)) == []


def test_a_new_part_is_read_alone_and_replaces_itself(spark, tmp_path):
    lake, kept = str(tmp_path / "lake"), str(tmp_path / "states")
    for number, first in enumerate((0, 40)):
        arrival.add_batch(lake, kept)(frame(spark, documents(first, 30)), number)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
    arrival.add_batch(lake, kept)(frame(spark, documents(80, 30)), 2)
    arrival.add_batch(lake, kept)(frame(spark, documents(80, 25)), 2)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "states").rglob("*.parquet")}
    assert before.items() <= after.items()
    every = frame(spark, documents(0, 30) + documents(40, 30) + documents(80, 25))
    state = states.merged(states.read_states(spark, kept))
    want = states.merged(states.resource_states(every, F.lit("all")))
    assert collected(state) == collected(want)


def test_a_broken_batch_is_taken_again(spark, tmp_path):
    source, lake, kept = (str(tmp_path / x) for x in ("in", "lake", "states"))
    docs = documents(0, 60)
    for k in range(6):
        lines = [json.dumps(d) for d in docs[k::6]] + ["", "no json", '{"id":"untyped"}']
        path = tmp_path / "in" / f"f{k}.ndjson"
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(lines))
    stream = arrival.arriving(spark, source, files_a_batch=2)
    add = arrival.add_batch(lake, kept)

    def broken(batch, number):
        add(batch, number)
        if number == 1:
            raise RuntimeError("lost")

    checkpoint = str(tmp_path / "checkpoint")
    writer = stream.writeStream.foreachBatch(broken).option("checkpointLocation", checkpoint)
    with pytest.raises(Exception, match="lost"):
        writer.trigger(availableNow=True).start().awaitTermination()
    for _ in range(2):  # the second time there is nothing left to take
        arrival.write_arrivals(stream, lake, checkpoint, kept).awaitTermination()
    resources.write_lake(frame(spark, docs), str(tmp_path / "whole"))
    whole = resources.read_lake(spark, str(tmp_path / "whole"))
    got = arrival.read_arrivals(spark, lake)
    assert collected(got.drop("json")) == collected(whole.select(*got.drop("json").columns))
    assert got.count() == len(docs)
    state = states.merged(states.read_states(spark, kept))
    assert collected(states.type_counts(state)) == collected(stats.resource_counts(whole))
