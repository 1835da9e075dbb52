"""Profiles of patients: wide, one column per metric, or sparse, a map of all codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def patient_profiles(rows: DataFrame, metrics: list[str]) -> DataFrame:
    """Pivot ``pid, code, value, date`` over a given metric list.

    Of several values the one with the earliest date is taken (ties by value, values
    without a date last), so the result does not depend on row order. Values are reduced per patient and
    metric before the shuffle.
    """
    return (
        rows.where(F.col("value").isNotNull())
        .groupBy("pid")
        .pivot("code", metrics)
        .agg(_earliest())
    )


def sparse_profiles(rows: DataFrame) -> DataFrame:
    """``pid, metrics``: for each patient a map of every code to its earliest value.

    The same choice of values as ``patient_profiles``, for any number of codes: the plan
    has two aggregates whatever their number. A patient's rows are reduced to one per code
    in each task and then by patient and code, so a very frequent patient is spread over
    the codes; what meets in one group is a value per code. Rows without a code
    give no entry, but their patient is kept.
    """
    return (
        rows.where(F.col("value").isNotNull())
        .groupBy("pid", "code")
        .agg(_earliest().alias("value"))
        .groupBy("pid")
        .agg(
            F.map_from_entries(
                F.array_sort(
                    F.collect_list(F.when(F.col("code").isNotNull(), F.struct("code", "value")))
                )
            ).alias("metrics")
        )
    )


def metric_columns(profiles: DataFrame, metrics: list[str]) -> DataFrame:
    """The wide table of some codes out of sparse profiles, without another shuffle."""
    return profiles.select("pid", *[F.col("metrics")[m].alias(m) for m in metrics])


def _earliest() -> Column:
    undated = F.col("date").isNull().alias("undated")
    return F.min(F.struct(undated, "date", "value"))["value"]
