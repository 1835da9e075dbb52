"""Numbers keep their digits, and the lake knows where that takes no care."""

import json
import random

from pyspark.sql import functions as F

from clinflat.functions.fhirpath import numbers_kept
from clinflat.operators import observation
from clinflat.sources import resources

SHAPES = ("72.5", "72.50", "0", "-0", "0.0", "-0.0", "1.0", "007", "1e2", "1E-7", "0.001", "0.0001", "0.0010",
          "9999999.5", "10000000.5", "123456789012345678", "12345678901234567890", "1234567.12345678", "0.1", "-3", "-3.25")


def _random_numbers(n):
    dice = random.Random(11)
    for _ in range(n):
        whole = str(dice.randrange(10 ** dice.randint(1, 8)))
        digits = "".join(dice.choice("0123456789") for _ in range(dice.randint(0, 11)))
        yield dice.choice(["", "-"]) + whole + ("." + digits if digits else "")


def test_numbers_said_to_be_kept_are(spark):
    texts = [*SHAPES, *_random_numbers(20000)]
    rows = spark.createDataFrame([(t, f'{{"value": {t}}}') for t in texts], "t string, json string")
    parsed = rows.select("t", numbers_kept(F.col("json")).alias("kept"), F.from_json("json", "value string")["value"].alias("v"))
    got = parsed.where("kept").collect()
    assert [r for r in got if r["t"] != r["v"]] == []
    assert {"72.5", "0", "1.0", "0.001", "-3.25"} <= {r["t"] for r in got}
    assert not {"72.50", "1e2", "0.0001", "-0"} & {r["t"] for r in got}


def test_lake_gives_the_digits_of_the_text(spark, tmp_path):
    docs = [
        f'{{"resourceType":"Observation","id":"o{i}","subject":{{"reference":"Patient/p"}},'
        f'"code":{{"coding":[{{"code":"c{i}"}}]}},"valueQuantity":{{"unit":{json.dumps("a b")},"value" : {t} }}}}'
        for i, t in enumerate(SHAPES) if t != "007"
    ]
    raw = resources.from_json_lines(spark.createDataFrame([(d,) for d in docs], "value string"))
    resources.write_lake(raw, str(tmp_path / "lake"))
    lake = resources.read_lake(spark, str(tmp_path / "lake"))
    expected = {f"c{i}": f"{t} a b" for i, t in enumerate(SHAPES) if t != "007"}
    for source in (raw, lake):
        assert {r["code"]: r["value"] for r in observation.measurements(source).collect()} == expected
    assert {r["numbers_kept"] for r in lake.collect()} == {True, False}
