"""Edge cases of observations, surveys and scans on small literals."""

import json
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinflat.functions import iso
from clinflat.operators import bundle, observation, stats, survey
from clinflat.operators.joins import left_lookup
from clinflat.operators.window import Window, resolve_window
from clinflat.sources import bundles, resources, sinks


def frame(spark, *docs):
    rows = [(d["resourceType"], d.get("id"), json.dumps(d, separators=(",", ":"))) for d in docs]
    return spark.createDataFrame(rows, "resource_type string, id string, json string")


def patient(pid, *values, **more):
    return {"resourceType": "Patient", "id": pid, "identifier": [{"value": v} for v in values], **more}


def obs(oid, ref, **more):
    return {"resourceType": "Observation", "id": oid, "subject": {"reference": ref}, **more}


def response(rid, items, **more):
    return {"resourceType": "QuestionnaireResponse", "id": rid, "item": items, **more}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


CODE = {"coding": [{"code": "c"}, {"code": "d", "display": "shown"}]}


def test_observation_edges(spark):
    observed = frame(
        spark,
        obs("1", "Patient/a", code=CODE, valueQuantity={"value": 72.50, "unit": "kg"}),
        obs("2", "http://h/Patient/b/_history/3", code=CODE, valueInteger=7,
            component=[{"code": CODE, "valueBoolean": False}, {"code": CODE}]),
        obs("3", "Group/a", code={}, valueString="text"),
        obs("4", "Patient/unknown", valueCodeableConcept={"coding": [{"code": "x"}, {"display": "y"}]}),
        obs("5", "Patient/a", code=CODE, component=[]),
        obs("6", "Patient/a", code=CODE, valueQuantity={"unit": "kg"}),
    )
    patients = frame(spark, patient("a", "ID-1", "ID-2"), {"resourceType": "Patient", "id": "b"})
    got = rows(observation.long_observations(observed, patients).drop("date"))
    assert got == sorted(
        [
            ("ID-1", "c", "shown", "72.5 kg"),
            ("b", "c", "shown", "7"),
            ("b", "c", "shown", "false"),
            (None, None, None, "text"),
            ("unknown", None, None, "y"),
        ],
        key=str,
    )


def test_salted_join_equals_broadcast(spark):
    facts = spark.range(5000).select(
        F.col("id").cast("string").alias("resource_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
    )
    lookup = spark.createDataFrame([("hot", "1"), ("k1", "2"), ("k1", "3")], "k string, v string")
    small = left_lookup(facts, lookup, ["k"])
    large = left_lookup(facts, lookup, ["k"], limit=0)
    assert rows(small) == rows(large.select(small.columns))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(small)
    assert "Generate" not in plan(large) and "pmod" in plan(large)


def nested(depth):
    item = {"linkId": f"d{depth}", "answer": [{"valueInteger": depth}]}
    for level in range(depth - 1, -1, -1):
        if level % 2:
            item = {"linkId": f"d{level}", "item": [item]}
        else:
            item = {"linkId": f"d{level}", "answer": [{"valueString": "a", "item": [item]}]}
    return [item]


@pytest.mark.parametrize("depth", [0, 3, 4, 7, 40])
def test_items_of_any_depth(spark, depth):
    items = survey.response_items(frame(spark, response("r", nested(depth))))
    assert {r["question_id"] for r in items.collect()} == {f"d{i}" for i in range(depth + 1)}
    last = items.where(F.col("question_id") == f"d{depth}").first()
    assert last["val_integer"] == str(depth)


ITEM = st.recursive(
    st.fixed_dictionaries({"linkId": st.text("abc", min_size=1, max_size=3)}),
    lambda inner: st.fixed_dictionaries(
        {"linkId": st.text("xyz", min_size=1, max_size=3)},
        optional={
            "item": st.lists(inner, max_size=3),
            "answer": st.lists(
                st.fixed_dictionaries({"valueInteger": st.integers(0, 9)},
                                      optional={"item": st.lists(inner, max_size=2)}),
                max_size=3,
            ),
        },
    ),
    max_leaves=8,
)


def walk(items):
    for i in items:
        yield i["linkId"]
        yield from walk(i.get("item", []))
        for a in i.get("answer", []):
            yield from walk(a.get("item", []))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(ITEM, max_size=4), min_size=1, max_size=8))
def test_unnest_finds_every_item(spark, documents):
    docs = [response(str(i), items) for i, items in enumerate(documents)]
    found = survey.response_items(frame(spark, *docs)).collect()
    assert sorted((r["resource_id"], r["question_id"]) for r in found) == sorted(
        (d["id"], link) for d in docs for link in walk(d["item"])
    )


def definition(qid, *items):
    return {"resourceType": "Questionnaire", "id": qid, "item": list(items)}


def test_survey_texts_and_choice(spark):
    definitions = frame(
        spark,
        definition("q1", {"linkId": "s", "text": "First", "answerOption": [
            {"valueCoding": {"code": "1", "display": "One"}}, {"valueCoding": {"code": "2"}}]}),
        definition("q2", {"linkId": "s", "text": "Second"}),
        definition("unused", {"linkId": "s", "text": "Third"}),
    )
    answered = frame(
        spark,
        response("1", [{"linkId": "s", "answer": [{"valueCoding": {"code": "1"}}]}],
                 questionnaire="http://h/Questionnaire/q1", authored="2024"),
        response("2", [{"linkId": "s", "answer": [{"valueCoding": {"code": "2"}}]},
                       {"text": "no link", "answer": [{"valueInteger": 1}]},
                       {"linkId": "no text", "answer": [{"valueInteger": 1}]},
                       {"linkId": "qty", "text": "Q", "answer": [{"valueQuantity": {"value": 1.0}}]}],
                 questionnaire="Questionnaire/q2"),
        response("3", [], questionnaire="Questionnaire/unused"),
        response("4", [], questionnaire="Questionnaire/q1|2"),
    )
    got = rows(survey.long_surveys(answered, definitions, frame(spark, patient("a"))))
    assert got == sorted(
        [
            (None, "s", "First", "One", "2024"), (None, "s", "Second", "2", None),
            (None, "qty", "Q", "1.0", None),
        ],
        key=str,
    )


def test_null_patient_counts_once(spark):
    data = spark.createDataFrame([("a",), (None,), (None,), ("a",)], "pid string")
    assert tuple(stats.row_counts(data).first()) == (4, 2)


def test_ages(spark):
    people = frame(spark, patient("1", birthDate="1990-01-01"), patient("2", birthDate="19x0"),
                   patient("3", birthDate="2000"), patient("4"))
    assert tuple(stats.age_stats(people, 2026).first()) == (26, 36)
    assert tuple(stats.age_stats(people.limit(0), 2026).first()) == (0, 0)


DATES = ["2024", "2024-05", "2024-05-31", "2024-05-31T23:59:59Z", "2024-05-31T23:30:00-02:00",
         "2024-06-01", None, "bad", "12:30", "2024-6-1"]


@pytest.mark.parametrize(
    "window, kept",
    [
        (Window("2024-06-01"), ["2024", "2024-05-31T23:30:00-02:00", "2024-06-01"]),
        (Window(None, "2024-05-31"), ["2024", "2024-05", "2024-05-31", "2024-05-31T23:59:59Z"]),
        (Window("2024-05-31", "2024-05-31"), ["2024", "2024-05", "2024-05-31", "2024-05-31T23:59:59Z"]),
        (Window(), DATES),
    ],
)
def test_date_window(spark, window, kept):
    docs = [
        {"resourceType": "Observation", "id": str(d), **({"effectiveDateTime": d} if d else {})}
        for d in DATES
    ]
    got = resources.scan(frame(spark, *docs), "Observation", window)
    assert sorted(r["id"] for r in got.collect()) == sorted(str(d) for d in kept)


def test_window_narrows_monotonically(spark):
    docs = frame(spark, *[{"resourceType": "Observation", "id": str(i),
                           "effectiveDateTime": f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}"} for i in range(200)])
    rng = random.Random(1)
    for _ in range(3):
        a, b = sorted(f"2024-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}" for _ in range(2))
        wide = {r["id"] for r in resources.scan(docs, "Observation", Window(a)).collect()}
        narrow = {r["id"] for r in resources.scan(docs, "Observation", Window(a, b)).collect()}
        assert narrow <= wide


@pytest.mark.parametrize(
    "request_, bounds",
    [
        ({"reference": "2026-04-01", "window": "P6M"}, ("2025-10-01", "2026-10-01")),
        ({"reference": "2024-03-31", "window": "P1M"}, ("2024-02-29", "2024-04-30")),
        ({"reference": "2024-03-31T10:00:00+02:00", "window": "PT12H"},
         ("2024-03-30T22:00:00+02:00", "2024-03-31T22:00:00+02:00")),
        ({"reference": "2024-03-31T00:00:00.500Z", "window": "PT0.25S"},
         ("2024-03-31T00:00:00.25Z", "2024-03-31T00:00:00.75Z")),
        ({"reference": "2024-03-31", "window": "P1Y2M3W4D"}, ("2023-01-06", "2025-06-25")),
        ({"explicit_from": "2024-01-01"}, ("2024-01-01", None)),
        ({}, (None, None)),
    ],
)
def test_resolve_window(spark, request_, bounds):
    w = resolve_window(spark, **request_)
    assert (w.date_from, w.date_to) == bounds


@pytest.mark.parametrize(
    "request_, message",
    [
        ({"reference": "2024-01-01"}, "requires --window"),
        ({"window": "P1D"}, "requires --reference"),
        ({"reference": "2024-01-01", "window": "1 day"}, "not a valid ISO-8601 duration"),
        ({"explicit_from": "2024-02-30"}, "not a valid ISO date"),
        ({"explicit_from": "2024-02-02", "explicit_to": "2024-02-01"}, "on or before"),
        ({"explicit_from": "2024-02-02", "window": "P1D"}, "cannot be combined"),
    ],
)
def test_resolve_window_errors(spark, request_, message):
    with pytest.raises(ValueError, match=message):
        resolve_window(spark, **request_)


def test_amounts(spark):
    texts = ["P1D", "-P1D", "P-2M", "P1DT12H", "PT-0.5S", "P", "PT", "P1DT", "1D", "P1H", "pt5m"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["a"] and tuple(r["a"]) for r in df.select("t", iso.amount(F.col("t")).alias("a")).collect()}
    assert got == {
        "P1D": (0, 1, 0), "-P1D": (0, -1, 0), "P-2M": (-2, 0, 0),
        "P1DT12H": (0, 0, 36 * 3600 * 10**6), "PT-0.5S": (0, 0, -500000), "P": None, "PT": None,
        "P1DT": None, "1D": None, "P1H": None, "pt5m": (0, 0, 300 * 10**6),
    }


def test_entries_round_trip(spark, tmp_path):
    source = frame(spark, patient("a"), obs("1", "Patient/a"), {"resourceType": "Questionnaire"})
    sinks.write_entries(bundle.transaction_entries(source), str(tmp_path))
    back = bundles.read_entries(spark, f"{tmp_path}/entries")
    assert rows(back) == rows(source)
    stored = spark.read.text(f"{tmp_path}/entries")
    lines = {r["rank"]: json.loads(r["value"]) for r in stored.collect()}
    assert {k: e["request"]["method"] for k, e in lines.items()} == {0: "PUT", 1: "PUT", 3: "POST"}
    head = json.loads(spark.read.text(f"{tmp_path}/envelope").first()[0])
    assert (head["resourceType"], head["type"]) == ("Bundle", "transaction")


def test_files_and_bundles(spark, tmp_path):
    docs = [patient("a"), obs("1", "Patient/a")]
    (tmp_path / "one.json").write_text(
        json.dumps({"resourceType": "Bundle", "entry": [{"resource": d} for d in docs] + [{"x": 1}]}, indent=1)
    )
    assert rows(bundles.read_bundles(spark, str(tmp_path)).select("id")) == [("1",), ("a",)]
    lines = tmp_path / "ndjson"
    lines.mkdir()
    (lines / "a.ndjson").write_text("\n".join([json.dumps(d) for d in docs] + ["", "junk", '{"id":"x"}']))
    assert resources.read_ndjson(spark, str(lines)).count() == 2


def test_folder_tree(spark, tmp_path):
    def put(folder, name, content):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(content)

    put("p1", "patient.json", json.dumps(patient("1")))
    put("p1", "o.json", json.dumps(obs("o", "Patient/1")))
    put("p1", "notes.txt", json.dumps(obs("ignored", "Patient/1")))
    put("p2", "someone.json", json.dumps(patient("2")))
    put("p2", "o.json", json.dumps(obs("o", "Patient/2")))
    put("p2", "broken.json", "{")
    put("other", "o.json", json.dumps(obs("lost", "Patient/3")))
    put("Questionnaire", "q.json", json.dumps(definition("q")))
    files = bundles.read_folders(spark, str(tmp_path))
    assert rows(bundle.patient_dirs(files)) == [("p1",), ("p2",)]
    kept = bundle.deduplicate(bundle.dir_resources(files))
    assert rows(kept.select("resource_type", "id", "dir")) == sorted(
        [("Patient", "1", "p1"), ("Patient", "2", "p2"), ("Observation", "o", "p1"),
         ("Questionnaire", "q", "Questionnaire")], key=str)


def test_pretty_printed_files_survive_bundling(spark, tmp_path):
    folder = tmp_path / "in" / "p1"
    folder.mkdir(parents=True)
    note = {"resourceType": "Observation", "status": "a\nb \" {x}", "subject": {"reference": "Patient/1"}}
    for name, doc, indent in (
        ("patient.json", patient("1"), 2), ("o.json", obs("o", "Patient/1"), 4),
        ("n1.json", note, 3), ("n2.json", note, None),
    ):
        (folder / name).write_text(json.dumps(doc, indent=indent))
    entries = bundle.folder_entries(bundles.read_folders(spark, str(tmp_path / "in")))
    assert entries.count() == 3  # the note is there twice, in two layouts
    sinks.write_entries(entries, str(tmp_path / "out"))
    back = bundles.read_entries(spark, f"{tmp_path}/out/entries").collect()
    got = sorted((json.loads(r["json"]) for r in back), key=lambda x: x["resourceType"] + x.get("id", ""))
    assert got == sorted([patient("1"), obs("o", "Patient/1"), note], key=lambda x: x["resourceType"] + x.get("id", ""))


def test_digits_of_numbers_are_kept(spark):
    numbers = ["0.1234567890123456789012", "72.50", "1E+30", "-0.0", "12345678901234567890123"]
    texts = [
        '{"resourceType":"Observation","id":"%d","subject":{"reference":"Patient/a"},'
        '"code":{"coding":[{"code":"c","display":"\\"value\\": 7.0"}]},"valueQuantity":{"value" : %s,"unit":"mg"}}'
        % (k, n)
        for k, n in enumerate(numbers)
    ]
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    found = resources.from_json_lines(lines)
    got = observation.long_observations(found, found).collect()
    assert sorted(r["value"] for r in got) == sorted(n + " mg" for n in numbers)
    assert {r["display"] for r in got} == {'"value": 7.0'}
    texts = [
        '{"resourceType":"QuestionnaireResponse","id":"%d","item":[{"linkId":"q","text":"t",'
        '"answer":[{"valueDecimal":%s}]}]}' % (k, n)
        for k, n in enumerate(numbers)
    ]
    found = resources.from_json_lines(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r["answer"] for r in survey.long_surveys(found, found, found).collect()) == sorted(numbers)


def test_link_ids_belong_to_their_questionnaire(spark):
    docs = [definition(f"q{k}", {"linkId": "1", "text": f"Text {k}"}) for k in range(50)]
    for k in range(50):
        r = response(f"r{k}", [{"linkId": "1", "answer": [{"valueInteger": k}]}])
        docs.append({**r, "questionnaire": f"Questionnaire/q{k}"})
    found = frame(spark, *docs)
    for limit in (0, 1 << 20):
        got = survey.long_surveys(found, found, found, limit)
        assert {(r["display"], r["answer"]) for r in got.collect()} == {(f"Text {k}", str(k)) for k in range(50)}
        assert got.count() == 50


def test_escaped_slashes_and_addresses(spark):
    names = resources.system_names(F.col("j"))
    df = spark.createDataFrame([('{"system":"http:\\/\\/loinc.org"}',), ('{"system":"http://loinc.org"}',)], "j string")
    assert {r[0][0] for r in df.select(names).collect()} == {"http://loinc.org"}
    triple = spark.createDataFrame(
        [("http://x/a b>c\nd", "http://x/p", "http://x/\\{e}", "iri", None, None)],
        "s string, p string, o string, o_kind string, lang string, datatype string",
    )
    assert sinks.ntriples(triple).first()[0] == (
        r"<http://x/a\u0020b\u003Ec\u000Ad> <http://x/p> <http://x/\u005C\u007Be\u007D> ."
    )


def test_dated_value_comes_first(spark):
    from clinflat.operators.profile import patient_profiles

    df = spark.createDataFrame(
        [("p", "c", "undated", None), ("p", "c", "late", "2024"), ("p", "c", "early", "2023")],
        "pid string, code string, value string, date string",
    )
    assert patient_profiles(df, ["c"]).first()["c"] == "early"


def test_window_means_utc_in_any_zone(spark):
    docs = [obs("1", "Patient/a", effectiveDateTime="2024-01-05T02:00:00Z"),
            obs("2", "Patient/a", effectiveDateTime="2024-01-04T23:00:00Z"),
            obs("3", "Patient/a", effectiveDateTime="2024-01-05")]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = resources.scan(frame(spark, *docs), "Observation", Window("2024-01-05"))
            assert {r["id"] for r in got.collect()} == {"1", "3"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_lake_files_cover_short_times(spark, tmp_path):
    import pyarrow.parquet as pq

    days = [f"20{y:02d}-{m:02d}-{d:02d}" for y in range(10, 20) for m in range(1, 13) for d in (1, 11, 21)]
    docs = [obs(str(k), "Patient/a", effectiveDateTime=x) for k, x in enumerate(days)]
    resources.write_lake(frame(spark, *docs), str(tmp_path))
    wanted = frame(spark, docs[0]).select(F.unix_micros(F.lit("2015-05-01T00:00:00Z").cast("timestamp"))).first()[0]
    read = total = 0
    for file in tmp_path.glob("resource_type=Observation/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = meta.schema.names
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(names.index(c)).statistics for c in ("date_lo", "date_hi")]
            total += 1
            read += stats[0].min <= wanted + 31 * 86400 * 10**6 and stats[1].max > wanted
    assert total >= 4 and read <= 2


def test_lake_prunes(spark, tmp_path):
    docs = [patient("a")] + [obs(str(i), "Patient/a", effectiveDateTime=f"2024-01-{i:02d}") for i in range(1, 29)]
    resources.write_lake(frame(spark, *docs), str(tmp_path))
    got = resources.scan(resources.read_lake(spark, str(tmp_path)), "Observation", Window("2024-01-20"))
    assert got.count() == 9
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(date_hi" in plan and "resource_type" in plan.split("PartitionFilters")[1]


def test_the_lake_is_stored_compactly(spark, tmp_path):
    resources.write_lake(frame(spark, patient("a")), str(tmp_path))
    files = [p.name for p in tmp_path.rglob("*.parquet")]
    assert files and all(".zstd." in name for name in files)
