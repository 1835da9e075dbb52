"""Observations to long rows ``pid, code, display, value, date``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.functions.fhirpath import (
    exact_json,
    first_coding,
    parse_once,
    reference_key,
    unnest,
    with_unit,
)
from clinflat.operators.joins import left_lookup
from clinflat.session import BROADCAST_BYTES
from clinflat.sources.resources import of_type

LONG_COLUMNS = ("pid", "code", "display", "value", "date")


def patient_id_map(patients: DataFrame) -> DataFrame:
    """``patient_uuid, pid``: the first identifier, or the resource id without one."""
    parsed = parse_once(of_type(patients, schemas.PATIENT_TYPE), schemas.PATIENT, "r")
    return parsed.select(
        F.col("r.id").alias("patient_uuid"),
        F.coalesce(F.get("r.identifier", F.lit(0))["value"], F.col("r.id")).alias("pid"),
    )


def parse(observations: DataFrame) -> DataFrame:
    """``resource_id, patient_uuid, date, r`` with the parsed observation in ``r``."""
    resources = of_type(observations, schemas.OBSERVATION_TYPE)
    return parse_once(
        resources, schemas.OBSERVATION, "r", "id", json=F.expr(exact_json(resources))
    ).select(
        F.col("id").alias("resource_id"),
        reference_key(F.col("r.subject.reference")).alias("patient_uuid"),
        F.col("r.effectiveDateTime").alias("date"),
        "r",
    )


def root_value(r: Column) -> Column:
    """Quantity, integer, text, then the coded display."""
    return F.coalesce(
        r["valueQuantity"]["value"],
        r["valueInteger"],
        r["valueString"],
        first_coding(r["valueCodeableConcept"]["coding"], "display"),
    )


def component_value(c: Column) -> Column:
    """Quantity, integer, text, boolean, date-time, then the coded display."""
    return F.coalesce(
        c["valueQuantity"]["value"],
        c["valueInteger"],
        c["valueString"],
        c["valueBoolean"],
        c["valueDateTime"],
        first_coding(c["valueCodeableConcept"]["coding"], "display"),
    )


def _measurement(node: Column, value: Column) -> Column:
    return F.struct(
        first_coding(node["code"]["coding"], "code").alias("code"),
        first_coding(node["code"]["coding"], "display").alias("display"),
        with_unit(value, node["valueQuantity"]["unit"]).alias("value"),
    )


def root_rows(observations: DataFrame) -> DataFrame:
    """The root fields of every observation, one row each, before the value choice."""
    r = F.col("r")
    return parse(observations).select(
        "patient_uuid",
        "date",
        first_coding(r["code"]["coding"], "code").alias("code"),
        first_coding(r["code"]["coding"], "display").alias("display"),
        r["valueQuantity"]["value"].alias("v_qty"),
        r["valueInteger"].alias("v_int"),
        r["valueString"].alias("v_str"),
        first_coding(r["valueCodeableConcept"]["coding"], "display").alias("v_code"),
        r["valueQuantity"]["unit"].alias("unit"),
    )


def component_rows(observations: DataFrame) -> DataFrame:
    """One row per component with the parent's patient and date."""
    c = F.col("c")
    components = unnest(parse(observations), F.col("r.component"), "c", "patient_uuid", "date")
    return components.select(
        "patient_uuid",
        "date",
        first_coding(c["code"]["coding"], "code").alias("code"),
        first_coding(c["code"]["coding"], "display").alias("display"),
        c["valueQuantity"]["value"].alias("c_qty"),
        c["valueInteger"].alias("c_int"),
        c["valueString"].alias("c_str"),
        c["valueBoolean"].alias("c_bool"),
        c["valueDateTime"].alias("c_dt"),
        first_coding(c["valueCodeableConcept"]["coding"], "display").alias("c_code"),
        c["valueQuantity"]["unit"].alias("unit"),
    )


def measurements(observations: DataFrame) -> DataFrame:
    """Root and component values with a value, in one pass over the resources.

    The root and its components become one array per resource and are unnested
    together, so each resource is read and parsed once and nothing is shuffled.
    """
    r = F.col("r")
    root = F.array(_measurement(r, root_value(r)))
    components = F.transform(r["component"], lambda c: _measurement(c, component_value(c)))
    both = F.concat(root, F.coalesce(components, F.slice(root, 1, 0)))
    valued = F.filter(both, lambda m: m["value"].isNotNull())
    rows = unnest(parse(observations), valued, "m", "resource_id", "patient_uuid", "date")
    return rows.select("resource_id", "patient_uuid", "m.code", "m.display", "m.value", "date")


def resolve_patient(
    rows: DataFrame, id_map: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``pid``: the mapped identifier, or the reference itself if unknown."""
    joined = left_lookup(rows, id_map, ["patient_uuid"], limit)
    return joined.withColumn("pid", F.coalesce("pid", "patient_uuid"))


def long_observations(
    observations: DataFrame, patients: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """The long observation table. ``limit``: bytes of a patient map that may be broadcast."""
    rows = resolve_patient(measurements(observations), patient_id_map(patients), limit)
    return rows.select(*LONG_COLUMNS)
