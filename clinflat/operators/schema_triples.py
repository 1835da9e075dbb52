"""Table-schema triples: output columns and data dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.functions.literals import boundary_literal, csvw_datatype, sample_size_literal
from clinflat.functions.text import concept_slug, sanitize_name, truthy_flag
from clinflat.namespaces import (
    COHORT,
    CSVW,
    DATASET_FILE,
    DCAT,
    DCT,
    FOAF,
    HEALTH,
    PROV,
    QUDT,
    RESPONSIBLE_ROLE,
    SKOS,
    VOCABULARY_BASE,
)
from clinflat.operators.triples import (
    as_graph,
    blank,
    blank_node,
    chosen,
    concept_schemes,
    emit,
    link,
    minted_urn,
    only_if,
    text,
    type_of,
    typed,
)
from clinflat.schemas import DICTIONARY_COLUMNS

# The facets of a dictionary, their scheme titles and link predicates.
FACETS = (
    ("Study", "study", "Studies / Cohorts", COHORT + "fromStudy"),
    ("Group", "section", "Variable groups / sections", SKOS + "broader"),
    (
        "Parent Group",
        "parent-group",
        "Parent groups (coarser groupings above Section)",
        SKOS + "broader",
    ),
    ("Selection", "selection", "Variable selection / inclusion status", COHORT + "selectionStatus"),
)

# Titles and descriptions of the table groups and tables.
OUTPUT_GROUP = ("Cohort Data Schema", "CSVW schema describing the flattened cohort dataset.")
OUTPUT_TABLE = "Tabular Data"
DICTIONARY_GROUP = (
    "Data Dictionary Schema",
    "CSVW schema describing the variables defined in the data dictionary.",
)
DICTIONARY_TABLE = "Variable Definitions"


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``name, type`` of a frame's columns."""
    rows = [(f.name, type(f.dataType).__name__) for f in df.schema.fields]
    return spark.createDataFrame(rows, "name string, type string")


def _group(subject: Column, parent: Column, title: str, description: str) -> list[Column]:
    return [
        type_of(subject, CSVW + "TableGroup"),
        text(subject, DCT + "title", title, "en"),
        text(subject, DCT + "description", description, "en"),
        link(subject, DCT + "isPartOf", F.nullif(parent, F.lit(""))),
    ]


def csvw_triples(columns: DataFrame) -> DataFrame:
    """Schema of output tables from ``subject, parent, name, type, vocab_id``.

    ``vocab_id`` is the vocabulary a column links to, or null.
    """
    subject, parent = F.col("subject"), F.col("parent")
    table = minted_urn(subject, F.lit("table"))
    column = minted_urn(subject, F.lit("column"), F.col("name"))
    return as_graph(
        emit(
            columns,
            [
                *_group(subject, parent, *OUTPUT_GROUP),
                type_of(table, CSVW + "Table"),
                text(table, DCT + "title", OUTPUT_TABLE, "en"),
                link(table, CSVW + "url", DATASET_FILE),
                link(subject, CSVW + "table", table),
                type_of(column, CSVW + "Column"),
                typed(column, CSVW + "name", sanitize_name(F.col("name")), "string"),
                text(column, CSVW + "titles", F.col("name"), "en"),
                text(
                    column, DCT + "description", F.concat(F.lit("Data values for "), "name"), "en"
                ),
                link(
                    column, CSVW + "propertyUrl",
                    F.concat(F.lit(f"{VOCABULARY_BASE}/"), "vocab_id"),
                ),
                typed(column, CSVW + "datatype", csvw_datatype(F.col("type")), "string"),
                link(table, CSVW + "column", column),
            ],
        )
    )


def _cell(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _variable_node() -> Column:
    """A node per dictionary row: rows that differ anywhere are different columns."""
    return minted_urn(F.col("subject"), F.lit("variable"), *[F.col(c) for c in DICTIONARY_COLUMNS])


def dictionary_triples(rows: DataFrame) -> DataFrame:
    """Schema of the variables of a dictionary: the 20 columns plus ``subject, parent``.

    Facets and value sets are separate graphs of the same nodes.
    """
    subject, parent = F.col("subject"), F.col("parent")
    table = F.col("table")
    group = [
        *_group(subject, parent, *DICTIONARY_GROUP),
        type_of(table, CSVW + "Table"),
        text(table, DCT + "title", DICTIONARY_TABLE, "en"),
        link(subject, CSVW + "table", table),
    ]
    nodes = rows.withColumn("node", _variable_node()).withColumn(
        "table", minted_urn(subject, F.lit("table"))
    )
    node = F.col("node")
    owner = blank_node(node, F.lit("owner"))
    attribution = blank_node(node, F.lit("attribution"))
    agent = blank_node(node, F.lit("responsible"))
    variables = emit(
        nodes,
        [
            *group,
            type_of(node, CSVW + "Column"),
            typed(node, CSVW + "name", F.col("Variable"), "string"),
            text(node, CSVW + "titles", F.col("Name"), "en"),
            typed(node, CSVW + "datatype", F.col("Datatype"), "string"),
            text(node, DCT + "description", _cell("Description"), "en"),
            link(node, CSVW + "propertyUrl", _cell("Property URL (ontology)")),
            text(node, QUDT + "unit", _cell("Unit")),
            text(node, HEALTH + "populationCoverage", _cell("Subpopulation")),
            *only_if(
                _cell("Sample Size"),
                chosen(node, COHORT + "sampleSize", sample_size_literal(F.col("Sample Size"))),
            ),
            *only_if(
                _cell("Data Owner"),
                blank(node, DCT + "rightsHolder", owner),
                type_of(owner, FOAF + "Agent"),
                text(owner, FOAF + "name", F.col("Data Owner")),
            ),
            typed(node, COHORT + "isIdentifier", truthy_flag(_cell("Identifier")), "boolean"),
            *only_if(
                _cell("Responsible"),
                blank(node, PROV + "qualifiedAttribution", attribution),
                type_of(attribution, PROV + "Attribution"),
                link(attribution, DCAT + "hadRole", RESPONSIBLE_ROLE),
                blank(attribution, PROV + "agent", agent),
                type_of(agent, FOAF + "Agent"),
                text(agent, FOAF + "name", F.col("Responsible")),
            ),
            text(node, SKOS + "scopeNote", _cell("Note"), "en"),
            *only_if(
                _cell("Min Value"),
                chosen(node, CSVW + "minimum", boundary_literal(F.col("Min Value"))),
            ),
            *only_if(
                _cell("Max Value"),
                chosen(node, CSVW + "maximum", boundary_literal(F.col("Max Value"))),
            ),
            typed(node, CSVW + "required", truthy_flag(_cell("Required")), "boolean"),
            text(node, COHORT + "conditionalOn", _cell("Conditional On"), "en"),
            link(table, CSVW + "column", node),
        ],
    )
    return as_graph(variables)


def facet_triples(rows: DataFrame) -> DataFrame:
    """Study, section, parent group and selection as concepts the variables link to.

    The schemes exist whether or not any variable uses them. Concept triples of
    equal facet values fall together in each task before the shuffle.
    """
    facets = F.array(
        *[
            F.struct(
                F.lit(path).alias("path"), F.lit(predicate).alias("predicate"),
                _cell(column).alias("value"),
            )
            for column, path, _, predicate in FACETS
        ]
    )
    nodes = rows.withColumn("node", _variable_node())
    values = nodes.select("node", F.explode(facets).alias("f")).select("node", "f.*")
    scheme = F.concat(F.lit(f"{VOCABULARY_BASE}/"), "path")
    concept = F.concat(scheme, F.lit("/"), concept_slug(F.col("value")))
    fixed = F.array(
        *[F.struct(F.lit(p).alias("path"), F.lit(t).alias("title")) for _, p, t, _ in FACETS]
    )
    schemes = emit(
        rows.sparkSession.range(1).select(F.inline(fixed)),
        [
            type_of(scheme, SKOS + "ConceptScheme"),
            text(scheme, DCT + "title", F.col("title"), "en"),
        ],
    )
    concepts = emit(
        values.where(F.col("value").isNotNull()),
        [
            type_of(concept, SKOS + "Concept"),
            link(concept, SKOS + "inScheme", scheme),
            text(concept, SKOS + "prefLabel", F.col("value"), "en"),
            link(scheme, SKOS + "hasTopConcept", concept),
            link(F.col("node"), F.col("predicate"), concept),
        ],
    )
    return as_graph(schemes, concepts)


def value_set_triples(value_sets: DataFrame) -> DataFrame:
    """Concept schemes of ``Variable, Code, Display``."""
    return concept_schemes(
        value_sets.select(
            F.col("Variable").alias("vocab_id"), F.col("Code").alias("code"),
            F.col("Display").alias("display"),
        )
    )
