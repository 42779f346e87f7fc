"""Lab-cohort processing on Spark: run sheets, result metadata, genotype packages and releases."""

__version__ = "0.1.0"
