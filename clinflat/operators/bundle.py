"""Transaction entries, and bundling of a folder tree of resource files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.functions.fhirpath import parse_once

# The folder of shared definitions and the file that marks a patient folder.
DEFINITION_FOLDER = "Questionnaire"
PATIENT_FILE = "patient.json"


def _request(resource_type: Column, rid: Column) -> tuple[Column, Column]:
    has_id = F.coalesce(rid, F.lit("")) != ""
    return (
        F.when(has_id, F.lit("PUT")).otherwise(F.lit("POST")),
        F.when(has_id, F.concat(resource_type, F.lit("/"), rid)).otherwise(resource_type),
    )


def type_rank() -> Column:
    """Position of a resource type in a bundle; other types come last."""
    rank = F.lit(len(schemas.RESOURCE_TYPES))
    for i, name in reversed(list(enumerate(schemas.RESOURCE_TYPES))):
        rank = F.when(F.col("resource_type") == name, i).otherwise(rank)
    return rank


def transaction_entries(resources: DataFrame) -> DataFrame:
    """``rank, resource_type, id, method, url, entry``: one entry per resource.

    Resources with an id are put, others posted. Nothing is removed. The entry is
    the JSON text on one line: a line break in JSON is layout, in a string it is escaped.
    ``rank`` and ``id`` give the order when one is wanted.
    """
    method, url = _request(F.col("resource_type"), F.col("id"))
    broken = F.contains("json", F.lit("\n")) | F.contains("json", F.lit("\r"))
    line = F.when(broken, F.regexp_replace("json", "[\r\n]+", " ")).otherwise(F.col("json"))
    entry = F.concat(
        F.lit('{"resource":'), line, F.lit(',"request":'),
        F.to_json(F.struct("method", "url")), F.lit("}"),
    )
    return (
        resources.select(
            type_rank().alias("rank"), "resource_type", "id", method.alias("method"),
            url.alias("url"), "json",
        )
        .withColumn("entry", entry)
        .drop("json")
    )


def envelope(timestamp: Column) -> Column:
    """The bundle's own fields, as JSON without its entries."""
    return F.to_json(
        F.struct(
            F.lit("Bundle").alias("resourceType"), F.lit("transaction").alias("type"),
            timestamp.alias("timestamp"),
        )
    )


def file_resources(files: DataFrame) -> DataFrame:
    """Files ``path, dir, file, json`` that hold a resource; other text is ignored."""
    head = "struct<resourceType:string,id:string>"
    return (
        parse_once(
            files.where(F.endswith(F.lower("file"), F.lit(".json"))), head, "h",
            "path", "dir", "file", "json",
        )
        .where(F.coalesce("h.resourceType", F.lit("")) != "")
        .select("path", "dir", "file", F.col("h.resourceType").alias("resource_type"),
                F.nullif("h.id", F.lit("")).alias("id"), "json")
    )


def patient_dirs(files: DataFrame) -> DataFrame:
    """Folders of patients: with a ``patient.json`` or any Patient resource.

    Grouping starts with the distinct marked folders of each task, so a folder
    with very many files costs no more than any other.
    """
    head = F.get_json_object("json", "$.resourceType")
    is_json = F.endswith(F.lower("file"), F.lit(".json"))
    marked = (F.col("file") == PATIENT_FILE) | (is_json & (head == schemas.PATIENT_TYPE))
    return files.where((F.col("dir") != DEFINITION_FOLDER) & marked).select("dir").distinct()


def dir_resources(files: DataFrame) -> DataFrame:
    """Resources in patient folders and in the definition folder."""
    folders = patient_dirs(files).unionByName(
        files.where(F.col("dir") == DEFINITION_FOLDER).select("dir").distinct()
    )
    return file_resources(files).join(folders, "dir", "left_semi")


def deduplicate(resources: DataFrame) -> DataFrame:
    """One resource per type and id, or per type and content without an id.

    Definitions come first, then folders and files by name. Copies are reduced in
    each task before the shuffle, so many copies of one resource do not pile up;
    content is compared by the SHA-256 digest of the parsed value, whatever its layout.
    """
    content = F.coalesce(F.to_json(F.try_parse_json("json")), F.col("json"))
    key = F.coalesce(
        F.concat(F.lit("id:"), "id"), F.concat(F.lit("sha:"), F.sha2(content, 256))
    )
    order = F.struct((F.col("dir") != DEFINITION_FOLDER).alias("late"), "dir", "file", "path")
    return (
        resources.withColumn("key", key)
        .groupBy("resource_type", "key")
        .agg(F.min_by(F.struct("id", "dir", "file", "json"), order).alias("first"))
        .select("resource_type", "first.*")
    )


def folder_entries(files: DataFrame) -> DataFrame:
    return transaction_entries(deduplicate(dir_resources(files)))
