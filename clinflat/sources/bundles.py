"""Bundle documents and folder trees of resource files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.functions.fhirpath import parse_once, unnest
from clinflat.sources.resources import from_json_lines


def bundle_resources(documents: DataFrame, column: str = "value") -> DataFrame:
    """``resource_type, id, json`` of every entry with a resource."""
    entries = F.expr("filter(b.entry.resource, r -> r is not null)")
    parsed = parse_once(documents, schemas.BUNDLE, "b", json=column)
    return from_json_lines(unnest(parsed, entries, "value"))


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """Bundle files, one document per file (search pages of bounded size).

    A document is one JSON value and cannot be split, so large exports belong in
    the one-entry-per-line form of ``read_entries``.
    """
    return bundle_resources(spark.read.text(path, wholetext=True))


def entry_resources(lines: DataFrame, column: str = "value") -> DataFrame:
    """Resources of transaction entries stored one per line."""
    head = parse_once(lines, "struct<resource:string>", "e", json=column)
    return from_json_lines(head.select(F.col("e.resource").alias("value")))


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return entry_resources(spark.read.text(path))


def folder_parts(path: Column) -> tuple[Column, Column]:
    """Parent folder name and file name of a path."""
    parts = F.split(path, "/")
    return F.element_at(parts, -2), F.element_at(parts, -1)


def read_folders(spark: SparkSession, root: str) -> DataFrame:
    """``path, dir, file, json`` of the files in the direct subfolders of a root.

    One resource file is one small document; the listing and reading is
    distributed like any other text scan.
    """
    files = spark.read.text(f"{root.rstrip('/')}/*/*", wholetext=True)
    named = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))
    folder, file = folder_parts(F.col("path"))
    return named.select("path", folder.alias("dir"), file.alias("file"), "json")
