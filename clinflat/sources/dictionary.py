"""Data-dictionary scans: REDCap CSV exports and variable sheets by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.functions.text import trim_whitespace
from clinflat.sources import csv_records

RAW_ROW = "__raw"

# Cell positions of the variable sheet; group, content and code
# notice exist once per language.
SHEET_POSITIONS = {
    "variable": 1,
    "selection": 2,
    "parent_table": 3,
    "study": 4,
    "data_owner": 11,
    "responsible": 12,
    "subpopulation": 13,
    "sample_size": 14,
    "raw_type": 15,
    "hidden": 23,
}
SHEET_LANGUAGE_POSITIONS = {
    "de": {"group": 5, "content": 7, "code_notice": 9},
    "en": {"group": 6, "content": 8, "code_notice": 10},
}


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Trimmed header names of the CSV files, which must all have the same."""
    return csv_records.header(csv_records.read_records(spark, path))


def read_dictionary_csv(spark: SparkSession, path: str, header: list[str] | None = None) -> DataFrame:
    """Dictionary rows as text: quoted commas, newlines and doubled quotes, cells
    trimmed, missing cells empty, rows with under half the cells dropped.

    A file is cut into records by many tasks. Short rows are padded with nulls, which
    cannot be told from empty cells, so such rows keep their raw text and their cells
    are counted there.
    """
    records = csv_records.read_records(spark, path)
    names = csv_records.header(records) if header is None else header
    # Cells are read by position; a header name may repeat, then the last one counts.
    last = {name: i for i, name in enumerate(names)}
    rows = csv_records.cells(records, names, RAW_ROW)
    unquoted = F.regexp_replace(RAW_ROW, '"(?:[^"]|"")*"', "q")
    cells = F.size(F.split(unquoted, ","))
    complete = F.col(RAW_ROW).isNull() | (cells * 2 >= len(names))
    return rows.where(complete).select(
        *[
            F.coalesce(trim_whitespace(F.col(f"_c{i}")), F.lit("")).alias(name)
            for name, i in last.items()
            if name
        ]
    )


def sheet_rows(cells: DataFrame, lang: str = "en") -> DataFrame:
    """Variable rows from a sheet given as ``row_idx, cells array<string>``.

    Row 0 is the header; missing and null cells are empty text.
    """
    positions = {**SHEET_POSITIONS, **SHEET_LANGUAGE_POSITIONS[lang]}
    return cells.where(F.col("row_idx") > 0).select(
        "row_idx",
        *[
            F.coalesce(trim_whitespace(F.get("cells", F.lit(i))), F.lit("")).alias(name)
            for name, i in positions.items()
        ],
    )
