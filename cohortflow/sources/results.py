"""Readers of quality result files: one JSON object per file, keyed by sample or library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kind of report: name of its key column, and its fields.
QC_SCHEMAS = {
    "sexdet": ("file", "x_rate double, x_err double, y_rate double, y_err double"),
    "snpcov": ("Sample_Name", "covered_snps bigint, total_snps bigint"),
    "nuccont": (
        "Library_ID",
        "contamination double, contamination_err double, contamination_snps bigint",
    ),
    "damage": ("Library_ID", "damage double, damage_reads bigint"),
    "endogenous": ("Library_ID", "endogenous double"),
}


def explode_report(df: DataFrame, report: Column, key: str, fields: str) -> DataFrame:
    """One row per entry of a JSON object whose values all have the given fields."""
    entries = F.from_json(report, f"map<string, struct<{_struct_fields(fields)}>>")
    names = [field.split()[0] for field in fields.split(",")]
    return df.select(F.explode(entries).alias(key, "_entry")).select(
        key, *[F.col(f"_entry.{name}").alias(name) for name in names]
    )


def _unreadable(report: Column, fields: str) -> Column:
    """True for text that is no JSON object, or one with an entry that is no object of the given kind."""
    entries = F.from_json(report, f"map<string, struct<{_struct_fields(fields)}>>")
    return entries.isNull() | F.exists(F.map_values(entries), lambda entry: entry.isNull())


def _struct_fields(fields: str) -> str:
    return ", ".join(":".join(field.split()) for field in fields.split(","))


def read_qc_json(
    spark: SparkSession, path: str, kind: str, pattern: str = "*.json", optional: bool = False
) -> DataFrame:
    """All reports of one kind under ``path`` (a file, a folder, or a glob), stacked.

    Fields a report lacks are NULL. With ``optional`` a folder that does not exist gives no rows. A report that
    cannot be read makes the job fail and is named; ``unreadable_reports`` lists all such reports. A file of zero
    length has no row at all in Spark's text source and gives none here.
    """
    key, fields = QC_SCHEMAS[kind]
    if optional and not path_exists(spark, path):
        return spark.createDataFrame([], f"{key} string, {fields}")
    reports = _report_texts(spark, path, pattern)
    broken = F.raise_error(F.concat(F.lit("unreadable report "), F.col("path")))
    value = F.when(_unreadable(F.col("value"), fields), broken).otherwise(F.col("value"))
    return explode_report(reports, value, key, fields)


def unreadable_reports(spark: SparkSession, path: str, kind: str, pattern: str = "*.json") -> DataFrame:
    """``path`` of each report of one kind that :func:`read_qc_json` cannot read."""
    _, fields = QC_SCHEMAS[kind]
    reports = _report_texts(spark, path, pattern)
    return reports.filter(_unreadable(F.col("value"), fields)).select("path")


def _report_texts(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    texts = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    return texts.select("value", F.col("_metadata.file_path").alias("path"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or anything a glob matches) exists in the file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = file_system.globStatus(hadoop_path)
    return found is not None and len(found) > 0
