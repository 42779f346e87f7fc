"""Readers of tabular inputs. Every schema is given; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import fixed_values as V
from cohortflow.functions import values

LIMS_TABLES = (
    "analysis",
    "raw_data",
    "sequencing",
    "capture",
    "library",
    "extract",
    "sample",
    "individual",
    "site",
    "batch",
)


def read_lims(
    spark: SparkSession,
    location: str,
    tables: Sequence[str] = LIMS_TABLES,
    properties: Mapping[str, str] | None = None,
    partitioning: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> dict[str, DataFrame]:
    """Lab tables from a ``jdbc:`` address or from a folder with one parquet table each.

    Over a database link, ``partitioning`` gives ``(column, lower, upper, partitions)`` per table, so
    that big tables are fetched in parallel; filters and column choices are pushed to the database.
    """
    if not location.startswith("jdbc:"):
        return {name: spark.read.parquet(f"{location}/{name}.parquet") for name in tables}

    def fetch(name: str) -> DataFrame:
        reader = spark.read.format("jdbc").options(url=location, dbtable=name, **(properties or {}))
        if partitioning and name in partitioning:
            column, lower, upper, partitions = partitioning[name]
            reader = reader.options(
                partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=partitions
            )
        return reader.load()

    return {name: fetch(name) for name in tables}


_SHEET_TYPES = {"Lane": T.LongType(), "Colour_Chemistry": T.IntegerType()}


def read_run_sheets(
    spark: SparkSession, path: str, layout: Sequence[str] = V.SHEET_KEYS
) -> DataFrame:
    """Run sheets of all individuals; ``layout`` names the key columns held by folder names.

    A file whose header names other columns, or the same ones in another order, makes the read fail.
    """
    inside = [c for c in (*V.SHEET_KEYS, *V.SHEET_COLUMNS) if c not in layout]
    fields = [T.StructField(c, _SHEET_TYPES.get(c, T.StringType())) for c in (*inside, *layout)]
    sheets = (
        spark.read.schema(T.StructType(fields))
        .option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", V.SHEET_MISSING)
        .csv(path)
        .select(*V.SHEET_KEYS, *V.SHEET_COLUMNS)
    )
    # An ID that does not start with a letter has an empty site, which comes back as a missing folder name.
    return sheets.withColumn("site_id", F.coalesce("site_id", F.lit("")))


def read_metadata(
    spark: SparkSession, path: str, columns: Sequence[str], types: T.StructType | None = None
) -> DataFrame:
    """Sample metadata: text columns in file order, ``n/a`` as missing; ``types`` casts some.

    A file whose header differs from ``columns`` makes the read fail.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    text = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", V.METADATA_MISSING)
        .csv(path)
    )
    return values.enforce_types(text, types) if types is not None else text


def check_format(fmt: str) -> None:
    """Fail before a job is built if the sample index format is not known."""
    if fmt not in V.IND_COLUMNS:
        accepted = " or ".join(V.IND_COLUMNS)
        raise ValueError(f"invalid sample index format {fmt!r}; must be {accepted}")


def read_ind(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Sample index without header; the six-column form gets its sex code decoded."""
    check_format(fmt)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in V.IND_COLUMNS[fmt]])
    index = spark.read.schema(schema).option("sep", "\t").csv(path)
    if fmt == "PLINK":
        index = index.withColumn("Genetic_Sex", values.decode_sex(F.col("sex_code")))
    return index


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """One ID per line as ``id``; blanks around it and empty lines go."""
    lines = spark.read.text(path).select(F.trim("value").alias("id"))
    return lines.filter(F.col("id") != "")

