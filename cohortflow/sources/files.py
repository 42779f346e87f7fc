"""File state and genotype text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.sources.listing import list_files, reachable


def scan_files(
    spark: SparkSession,
    root: str,
    pattern: str = "*",
    content: bool = False,
    modified_after: str | None = None,
) -> DataFrame:
    """Files below ``root`` whose name matches: ``path, modificationTime, length``.

    Folders are listed on executors, and files without any content count (:mod:`cohortflow.sources.listing`). Where only
    Spark's own file systems reach the path, and where ``content`` is asked for, Spark's file scan is used,
    which leaves empty files out. Files and folders whose name starts with a dot or an underscore are skipped.
    ``modified_after`` (``yyyy-MM-ddTHH:mm:ss``, UTC) drops older files while they are listed.
    """
    if not content and reachable(root):
        return list_files(spark, root, pattern, modified_after)
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
    )
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(root)
    columns = ["path", "modificationTime", "length"]
    return files.select(*columns, "content") if content else files.select(*columns)


def numbered_lines(spark: SparkSession, path: str, name: str, per_file: bool = False) -> DataFrame:
    """Lines of text files with their 0-based position, as ``path, <name>, line``.

    Positions run on through the part files of a folder in name order, or start again in each file.
    A line's position is its place inside its file block plus the lines of the blocks before. A
    block is no larger than one read partition, so no task numbers more than that.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_read_order"),
        F.col("value").alias("line"),
    )
    blocks = lines.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_lines"))
    # One row per file block; part numbers with more digits come later.
    order = Window.orderBy(F.length("path"), "path", "_block")
    if per_file:
        order = Window.partitionBy("path").orderBy("_block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "path", "_block", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy("path", "_block").orderBy("_read_order")
    return lines.join(offsets, ["path", "_block"]).select(
        "path", (F.row_number().over(within) - 1 + F.col("_before")).alias(name), "line"
    )


def read_geno(spark: SparkSession, path: str) -> DataFrame:
    """Genotype matrix as ``snp_idx, line``; ``path`` is a file or a folder of parts."""
    return numbered_lines(spark, path, "snp_idx").drop("path")


SNP_COLUMNS = {
    "snp_id": "string",
    "chrom": "string",
    "genetic_pos": "double",
    "pos": "bigint",
    "ref": "string",
    "alt": "string",
}


def read_snp(spark: SparkSession, path: str) -> DataFrame:
    """SNP list separated by blanks or tabs, with the line position ``snp_idx`` of each SNP."""
    lines = numbered_lines(spark, path, "snp_idx")
    parts = F.split(F.trim("line"), r"\s+")
    columns = [
        F.get(parts, F.lit(place)).cast(kind).alias(name)
        for place, (name, kind) in enumerate(SNP_COLUMNS.items())
    ]
    return lines.select("snp_idx", *columns)


def read_positioned_ind(spark: SparkSession, path: str) -> DataFrame:
    """Three-column sample index with the file position ``pos`` that genotype columns refer to."""
    lines = numbered_lines(spark, path, "pos")
    parts = F.split("line", "\t")
    columns = [
        F.get(parts, F.lit(place)).alias(name)
        for place, name in enumerate(V.IND_COLUMNS["EIGENSTRAT"])
    ]
    return lines.select("pos", *columns)
