"""Statistics of a table's own patients, and names of systems in any spelling."""

from pyspark.sql import functions as F

from clinflat.operators import observation, stats
from clinflat.sources.resources import system_names
from test_resources import frame, obs, patient


def test_ages_and_dates_of_the_cohort(spark):
    people = frame(
        spark, patient("p1", "A", birthDate="1990-01-01"), patient("p2", birthDate="1980"),
        patient("p3", "C", birthDate="1900-05-05"), patient("p4", "D"),
    )
    seen = frame(
        spark, *[obs(f"o{i}", f"Patient/p{i}", valueString="v", effectiveDateTime=f"202{i}-03-04") for i in (1, 2, 4)],
        obs("o5", "Patient/p3", effectiveDateTime="1999-01-01"),
    )
    rows = observation.long_observations(seen, people)
    coverage = stats.temporal_coverage(seen, "Observation")
    every = stats.dataset_stats(rows, people, coverage, 2026).first()
    own = stats.dataset_stats(rows, people, coverage, 2026, cohort_only=True).first()
    assert (every["min_age"], every["max_age"], every["start_date"]) == (36, 126, "1999-01-01")
    assert (own["min_age"], own["max_age"], own["start_date"], own["end_date"]) == (36, 46, "2021-03-04", "2024-03-04")
    none = stats.dataset_stats(rows.limit(0), people, coverage, 2026, cohort_only=True).first()
    assert tuple(none) == (0, 0, 0, 0, None, None)


def test_system_names_in_any_spelling(spark):
    texts = [
        r'{"system":"http:\/\/a\/b"}', r'{"system" : "http://a/b"}', r'{"system":"q\"x\\y"}',
        r'{"system":"a\u0026b","c":{"system":""}}', r'{"system":"bad\x"}', "{}",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "j string")
    got = [r[0] for r in rows.select(system_names(F.col("j"))).collect()]
    assert got == [["http://a/b"], ["http://a/b"], ['q"x\\y'], ["a&b"], ["bad\\x"], []]
