"""Edge cases of dictionaries, metadata and graphs; the jobs end to end."""

import json

from pyspark.sql import functions as F

from clinflat.functions import text as tx
from clinflat.operators import dictionary as dic
from clinflat.operators import profile, vocab
from clinflat.operators.triples import TRIPLE_COLUMNS
from clinflat.plans import jobs
from clinflat.schemas import REDCAP_COLUMNS
from clinflat.sources import dictionary as src
from clinflat.sources import metadata
from test_resources import CODE, definition, frame, obs, patient, response, rows


def test_dictionary_csv(spark, tmp_path):
    header = ",".join(f'"{c}"' for c in REDCAP_COLUMNS)
    text = (
        "﻿" + header + "\r\n"
        'a,form,,radio," Label ""quoted"", with\nnewline ","1, Yes | 2, No",,,,,,,y\r\n'
        "short,form,,text,Label,,\r\n"
        "tiny,form,,\r\n"
        " b ,form,,text,,,,,,,,,\r\n"
    )
    (tmp_path / "d.csv").write_bytes(text.encode())
    got = src.read_dictionary_csv(spark, str(tmp_path / "d.csv"))
    assert got.columns == list(REDCAP_COLUMNS)
    by_name = {r[0]: r for r in got.collect()}
    assert sorted(by_name) == ["a", "b", "short"]
    assert by_name["a"]["Field Label"] == 'Label "quoted", with\nnewline'
    assert by_name["short"]["Required Field?"] == ""
    assert rows(dic.redcap_value_sets(got)) == [("a", "1", "Yes"), ("a", "2", "No")]


def test_text_edges(spark):
    df = spark.createDataFrame([("&amp;lt;b&amp;gt; ", "abc1g", "x_y/")], "html string, hex string, uri string")
    got = df.select(
        tx.strip_html(F.col("html")), tx.hex_clean(F.col("hex")), tx.uri_label(F.col("uri")),
        tx.hex_clean(F.lit("g")), tx.int_from_text(F.lit("1e12")), tx.date_guard(F.lit("2024-01-01\n")),
    ).first()
    assert tuple(got) == ("<b>", "abc1", "x y", None, 2147483647, None)


def test_choices_edges(spark):
    texts = ["1,a|2,b", "1,a", ",a|2,b|3,c", "1, a, b | 2 , c", "", None, "a|b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: [tuple(x) for x in r["c"]] if r["c"] else [] for r in
           df.select("i", dic.choices(F.col("t")).alias("c")).collect()}
    assert got == {
        0: [("1", "a"), ("2", "b")], 1: [], 2: [("2", "b"), ("3", "c")],
        3: [("1", "a, b"), ("2", "c")], 4: [], 5: [], 6: [],
    }


def test_profile_takes_earliest(spark):
    data = spark.createDataFrame(
        [("p", "x", "late", "2024-02"), ("p", "x", "early", "2024-01"), ("p", "y", None, "2024"),
         ("q", "z", "1", "2024")],
        "pid string, code string, value string, date string",
    )
    got = profile.patient_profiles(data, ["x", "y"])
    assert got.columns == ["pid", "x", "y"]
    assert rows(got) == [("p", "early", None), ("q", None, None)]


def test_column_links_fall_back(spark):
    vocabularies = spark.createDataFrame([("question_codes", "a", "b")], "vocab_id string, code string, display string")
    assert rows(vocab.column_links(vocabularies)) == [("code", "question_codes"), ("display", "question_codes")]
    assert vocab.column_links(vocabularies.limit(0)).count() == 0


def test_unknown_job_lists_known_ones(spark):
    records = spark.createDataFrame([("survey",), ("full",)], "job string")
    try:
        metadata.for_job(records, "nope")
    except ValueError as e:
        assert "full, survey" in str(e)
    else:
        raise AssertionError("no error")


def test_jobs_end_to_end(spark, tmp_path):
    resources = frame(
        spark,
        patient("a", "ID-1", birthDate="1980"),
        obs("1", "Patient/a", code=CODE, valueInteger=1, effectiveDateTime="2024-01-02"),
        obs("2", "Patient/a", code=CODE, valueInteger=2, effectiveDateTime="2020-01-02"),
        response("r", [{"linkId": "s", "answer": [{"valueCoding": {"system": "urn:s", "code": "1"}}]}],
                 questionnaire="Questionnaire/q", authored="2024-03-01", subject={"reference": "Patient/a"}),
        definition("q", {"linkId": "s", "text": "Asked", "answerOption": [{"valueCoding": {"code": "1", "display": "One"}}]}),
    )
    (tmp_path / "meta.json").write_text(json.dumps({
        "catalog": {"title": "C"},
        "jobs": {"full": {"dataset": {"title": "D", "contactPoint": {}, "hdab": {"contactPoint": {}}},
                          "distribution": {"title": "X"}}},
    }))
    records = metadata.read_documents(spark, str(tmp_path / "meta.json"))
    out = str(tmp_path / "out")
    jobs.run_jobs(spark, resources, records, out, ["bundle", "full"], 2026, "run",
                  jobs.Window("2024-01-01"), fmt="parquet")
    table = spark.read.parquet(f"{out}/patient_data/data")
    assert rows(table) == [
        ("ID-1", "c", "shown", "1", "2024-01-02"), ("ID-1", "s", "Asked", "One", "2024-03-01")]
    dataset = "\n".join(r[0] for r in spark.read.text(f"{out}/patient_data/rdf/Dataset").collect())
    for part in ('numberOfRecords> "2"', 'minTypicalAge> "46"', 'startDate> "2024-01-02"', "<urn:s>"):
        assert part in dataset
    schema = [r[0] for r in spark.read.text(f"{out}/patient_data/rdf/CSVW").collect()]
    assert len(schema) == len(set(schema))
    assert sum("vocab/observation_codes> ." in s and "propertyUrl" in s for s in schema) == 2
    assert sum('"One"@en' in s for s in schema) == 1
    assert spark.read.text(f"{out}/bundle_extraction/entries").count() == 4


def test_jobs_stop_on_unknown_and_undescribed(spark, tmp_path):
    import pytest

    resources = frame(spark, patient("a"))
    records = spark.createDataFrame([("full",)], "job string")
    for names, message in ((["nope"], "unknown jobs: nope"), (["survey"], "No metadata found")):
        with pytest.raises(ValueError, match=message):
            jobs.run_jobs(spark, resources, records, str(tmp_path / "o"), names, 2026, "run")


def test_metadata_job(spark, tmp_path):
    import pytest

    field = {"name": "v", "title": "Weight " * 400, "datatype": "decimal", "unit": "kg"}
    job = {"dataset": {"title": "D", "numRecords": 7}, "distribution": {"title": "X"},
           "dataDictionary": [field], "dataDictionaryValueSets": {"v": {"1": "One"}}}
    def records(name, job):
        (tmp_path / name).write_text(json.dumps({"catalog": {"title": "C"}, "jobs": {"survey": job}}))
        return metadata.read_documents(spark, str(tmp_path / name))

    out = str(tmp_path / "out")
    jobs.run_metadata(records("a.json", job), out, "run")
    text = {g: "\n".join(r[0] for r in spark.read.text(f"{out}/{g}").collect())
            for g in ("Catalog", "Dataset", "Distribution", "CSVW")}
    assert 'numberOfRecords> "7"' in text["Dataset"] and '"C"' in text["Catalog"]
    assert '"One"@en' in text["CSVW"] and ("Weight " * 400).strip() in text["CSVW"]
    field["datatype"] = " "
    with pytest.raises(ValueError, match="'Datatype' field cannot be empty"):
        jobs.run_metadata(records("b.json", job), str(tmp_path / "no"), "run")


def test_dictionary_files_with_different_headers(spark, tmp_path):
    import pytest

    from clinflat.sources import dictionary as src

    for name, text in (("a.csv", "A,B\n1,2\n"), ("b.csv", "B,A\n3,4\n")):
        (tmp_path / name).write_text(text)
    with pytest.raises(ValueError, match="different header rows"):
        src.read_dictionary_csv(spark, str(tmp_path))
    assert src.read_dictionary_csv(spark, str(tmp_path / "b.csv")).first().asDict() == {"B": "3", "A": "4"}


def test_dictionary_job(spark, tmp_path):
    redcap = spark.createDataFrame(
        [tuple("v form  radio Label 1,a|2,b".replace("  ", " - ").split(" ")[i] if i < 6 else "" for i in range(13))],
        [*REDCAP_COLUMNS],
    )
    jobs.run_dictionary(dic.redcap_dictionary(redcap, "S"), dic.redcap_value_sets(redcap), str(tmp_path / "t"), "urn:d")
    lines = [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()]
    assert len(lines) == len(set(lines)) and any("vocab/v/1>" in s for s in lines)
    assert len(TRIPLE_COLUMNS) == 6
