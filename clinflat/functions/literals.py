"""Typed-literal choice: a (lexical text, datatype, language) struct per value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clinflat.functions.text import trim_cell
from clinflat.namespaces import XSD


def literal(o: Column, datatype: str | None = None, lang: str | None = None) -> Column:
    return F.struct(
        o.cast("string").alias("o"),
        F.lit(datatype).cast("string").alias("datatype"),
        F.lit(lang).cast("string").alias("lang"),
    )


def boundary_literal(c: Column) -> Column:
    """Whole number, then double, then English text."""
    t = trim_cell(c)
    whole, real = t.try_cast("bigint"), t.try_cast("double")
    return (
        F.when(whole.isNotNull(), literal(whole, XSD + "integer"))
        .when(real.isNotNull(), literal(real, XSD + "double"))
        .otherwise(literal(t, None, "en"))
    )


def sample_size_literal(c: Column) -> Column:
    """Whole number, else the untrimmed text in English."""
    whole = trim_cell(c).try_cast("bigint")
    return F.when(
        whole.isNotNull(), literal(whole, XSD + "nonNegativeInteger")
    ).otherwise(literal(c, None, "en"))


def csvw_datatype(type_name: Column) -> Column:
    t = F.lower(type_name)
    return (
        F.when(t.contains("int") | t.contains("long"), F.lit("integer"))
        .when(t.contains("double") | t.contains("float"), F.lit("double"))
        .when(t.contains("binary"), F.lit("binary"))
        .otherwise(F.lit("string"))
    )
