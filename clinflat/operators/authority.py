"""Labels of authority lists, from a table of triples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinflat.namespaces import SKOS


def authority_labels(triples: DataFrame, scheme: str | None = None) -> DataFrame:
    """Distinct ``scheme, uri, label``: concepts in a scheme with an English label.

    ``scheme`` restricts to one list; the order is by label.
    """
    members = triples.where(F.col("p") == SKOS + "inScheme").select(
        F.col("s").alias("uri"), F.col("o").alias("scheme")
    )
    if scheme is not None:
        members = members.where(F.col("scheme") == scheme.rstrip("/"))
    labels = triples.where((F.col("p") == SKOS + "prefLabel") & (F.col("lang") == "en")).select(
        F.col("s").alias("uri"), F.col("o").alias("label")
    )
    return (
        members.distinct().join(labels.distinct(), "uri")
        .select("scheme", "uri", "label")
        .orderBy("label", "uri", "scheme")
    )
