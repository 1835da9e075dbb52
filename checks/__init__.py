"""Registered queries with their SQL equivalents, grouped by subject."""

from checks import (
    dictionaries,
    folders,
    graphs,
    metadata,
    observations,
    scalars,
    surveys,
    windows,
)

GROUPS = (
    observations, surveys, windows, scalars, dictionaries, folders, metadata, graphs,
)
