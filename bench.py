"""Time the headline queries; prints one JSON line.

The clinical resources are derived from the test tables and written once as
parquet by type, outside the timing: the queries then start from stored resources,
as they do in use. Each query runs once to warm up and then ``BENCH_RUNS`` times;
the median counts. Results go to the no-op sink, so all rows are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from checks import dictionaries, fixtures, graphs
from clinflat.namespaces import OBSERVATION_CODES, QUESTION_CODES
from clinflat.operators import bundle, full, observation, profile, stats, survey, triples, vocab
from clinflat.operators.window import Window
from clinflat.sources import resources as scans

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("clinflat-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="clinflat-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def queries(spark: SparkSession, lake: str) -> dict:
    stored = scans.read_lake(spark, lake)

    def of(resource_type: str):
        return scans.of_type(stored, resource_type)

    patients, observed = of("Patient"), of("Observation")
    responses, definitions = of("QuestionnaireResponse"), of("Questionnaire")

    def obs_long():
        return observation.long_observations(observed, patients)

    def survey_long():
        return survey.long_surveys(responses, definitions, patients)

    def skos_triples():
        surveyed, in_use = survey.extract(responses, definitions, patients)
        return triples.concept_schemes(
            vocab.merge_vocabularies(
                vocab.option_vocabularies(in_use),
                vocab.code_vocabulary(obs_long(), OBSERVATION_CODES),
                vocab.code_vocabulary(surveyed, QUESTION_CODES),
            )
        )

    def dataset_stats():
        coverage = stats.temporal_coverage(observed, "Observation")
        return stats.dataset_stats(obs_long(), patients, coverage, 2026)

    return {
        "obs_long": obs_long,
        "survey_long": survey_long,
        "full_long": lambda: full.long_full(obs_long(), survey_long()),
        "coding_systems": lambda: stats.coding_systems(observed, responses, definitions, patients),
        "skos_triples": skos_triples,
        "dataset_stats": dataset_stats,
        "profile_pivot": lambda: profile.patient_profiles(
            obs_long(), ["click", "view", "error", "purchase", "signup"]
        ),
        "window_filter_qr": lambda: scans.scan(
            stored, "QuestionnaireResponse", Window("1997-02", "1998-06-15")
        ),
        "bundle_entries": lambda: bundle.transaction_entries(stored),
        "redcap_dictionary": lambda: dictionaries.redcap_dictionary(spark, SF_DIR),
        "facet_triples": lambda: graphs.facet_triples(spark, SF_DIR),
    }


def run(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    lake = f"{tempfile.mkdtemp(prefix='clinflat-bench-lake-')}/resources"
    scans.write_lake(fixtures.resources(spark, SF_DIR), lake)
    times = {}
    for name, build in queries(spark, lake).items():
        if ONLY and name not in ONLY:
            continue
        first = run(build)
        times[name] = round(statistics.median([run(build) for _ in range(RUNS)]), 3)
        print(f"{name}: first {first:.2f}s, median {times[name]:.2f}s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
