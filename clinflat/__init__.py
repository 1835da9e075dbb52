"""Clinical-record flattening, statistics and metadata as Spark DataFrame transformations."""
