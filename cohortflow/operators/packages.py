"""Data packages: checks before publishing, checksums, versions and change log."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import fixed_values as V
from cohortflow.session import written
from cohortflow.sources.listing import file_system, walk

CHECKS = (
    "snps_match_lines",
    "samples_match_width",
    "samples_are_unique",
    "snps_are_unique",
    "calls_are_legal",
)


def validate_package(
    lines: DataFrame,
    snps: DataFrame,
    inds: DataFrame,
    calls: tuple[str, ...] = V.GENOTYPE_CALLS,
) -> DataFrame:
    """Check rows ``(package_id, check, expected, found, ok)``, five per package.

    ``lines`` has ``package_id, line``, ``snps`` ``package_id, snp_id``, ``inds``
    ``package_id, sample_id``. A package missing from one of them fails its counts.
    """
    legal = f"^[{''.join(calls)}]*$"
    # The width that stands out is reported, so one wrong line is enough to fail.
    widths = lines.groupBy("package_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min(F.length("line")).cast("long").alias("narrow"),
        F.max(F.length("line")).cast("long").alias("wide"),
        F.count_if(~F.col("line").rlike(legal)).alias("illegal"),
    )
    snp_counts = _repeats(snps, "snp_id", "n_snps", "repeated_snps")
    sample_counts = _repeats(inds, "sample_id", "n_samples", "repeated_samples")
    joined = (
        widths.join(snp_counts, "package_id", "full_outer")
        .join(sample_counts, "package_id", "full_outer")
        .na.fill(0)
    )
    width = F.when(F.col("narrow") != F.col("n_samples"), F.col("narrow")).otherwise(F.col("wide"))
    zero = F.lit(0).cast("long")
    pairs = (
        (F.col("n_snps"), F.col("n_lines")),
        (F.col("n_samples"), width),
        (zero, F.col("repeated_samples")),
        (zero, F.col("repeated_snps")),
        (zero, F.col("illegal")),
    )
    rows = [
        F.struct(F.lit(check).alias("check"), expected.alias("expected"), found.alias("found"))
        for check, (expected, found) in zip(CHECKS, pairs)
    ]
    return joined.select("package_id", F.inline(F.array(*rows))).withColumn(
        "ok", F.col("expected") == F.col("found")
    )


def _repeats(df: DataFrame, column: str, total: str, repeated: str) -> DataFrame:
    """Rows per package, and how many of them repeat an earlier value."""
    per_value = df.groupBy("package_id", column).agg(F.count(F.lit(1)).alias("_n"))
    return per_value.groupBy("package_id").agg(
        F.sum("_n").alias(total), F.sum(F.col("_n") - 1).alias(repeated)
    )


def valid_packages(checks: DataFrame) -> DataFrame:
    """Packages that pass every check."""
    verdicts = checks.groupBy("package_id").agg(F.bool_and("ok").alias("ok"))
    return verdicts.filter("ok").select("package_id")


def checksums(files: DataFrame) -> DataFrame:
    """MD5 of each file of a ``binaryFile`` scan with content; files are hashed where they are read."""
    return files.select("path", "length", F.md5("content").alias("md5"))


# Bytes that one task reads of a file, and at a time.
DIGEST_BLOCK = 64 << 20
_READ = 4 << 20


def _hash_blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path, length, number in zip(*(batch.column(name).to_pylist() for name in ("path", "length", "_block"))):
            files, inner, _ = file_system(path)
            found, at, end = hashlib.md5(usedforsecurity=False), number * block, min((number + 1) * block, length)
            with files.open_input_file(inner) as file:
                while at < end:
                    data = file.read_at(min(_READ, end - at), at)
                    if not data:
                        raise OSError(f"{path} is shorter than it was listed")
                    found.update(data)
                    at += len(data)
            digests.append(found.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in batch.schema.names), pa.array(digests, pa.string())],
            names=[*batch.schema.names, "_md5"],
        )


def tree_digests(files: DataFrame, block: int = DIGEST_BLOCK) -> DataFrame:
    """``n_blocks`` and ``md5`` of each listed file (``path, length`` and other columns), read in blocks by many tasks.

    A file of one block has the MD5 of its content. One of several has the MD5 of their MD5s and, after a dash, their number, as
    object stores write it. So no task reads, and no cell holds, more than a block of a file.
    """
    columns = files.columns
    last = F.greatest(F.ceil(F.col("length") / block) - 1, F.lit(0)).cast("long")
    # A fixed number of partitions: rows this short would otherwise be put into one task, which would read all files.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = files.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    blocks = blocks.repartition(tasks, "path", "_block")
    schema = T.StructType([*blocks.schema, T.StructField("_md5", T.StringType())])
    hashed = blocks.mapInArrow(lambda batches: _hash_blocks(batches, block), schema)
    listed = hashed.groupBy(*columns).agg(F.array_sort(F.collect_list(F.struct("_block", "_md5"))).alias("_all"))
    joined = F.md5(F.unhex(F.array_join(F.transform("_all", lambda one: one["_md5"]), "")))
    whole = F.when(F.size("_all") == 1, F.col("_all")[0]["_md5"]).otherwise(
        F.concat(joined, F.lit("-"), F.size("_all").cast("string"))
    )
    return listed.select(*columns, F.size("_all").cast("long").alias("n_blocks"), whole.alias("md5"))


def manifest(staged: DataFrame, block: int = DIGEST_BLOCK) -> DataFrame:
    """``package_id, name, length, n_blocks, md5`` of every file below the folders of staged packages ``(package_id, path)``."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package, root in zip(batch.column("package_id").to_pylist(), batch.column("path").to_pylist()):
                files, inner, prefix = file_system(root)
                found = list(walk(files, inner, True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([package] * len(found), pa.string()),
                        pa.array([one.path[len(inner) :].lstrip("/") for one in found], pa.string()),
                        pa.array([f"{prefix}{one.path}" for one in found], pa.string()),
                        pa.array([one.size for one in found], pa.int64()),
                    ],
                    names=["package_id", "name", "path", "length"],
                )

    tasks = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = staged.select("package_id", "path").repartition(tasks, "package_id").mapInArrow(
        listed, "package_id string, name string, path string, length bigint"
    )
    return written(tree_digests(files, block).drop("path"), "manifest")


def package_digests(files: DataFrame) -> DataFrame:
    """``package_id, digest``: one digest of the names and digests of a package's files."""
    entry = F.concat_ws(" ", "md5", "name")
    return files.groupBy("package_id").agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", entry.alias("e")))), lambda x: x["e"]), "\n").cast("binary")).alias("digest")
    )


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """``package_id, name, change`` between two manifests: ``added``, ``removed`` or ``changed`` files."""
    keys = ["package_id", "name"]
    old = before.select(*keys, F.struct("length", "md5").alias("_old"))
    new = after.select(*keys, F.struct("length", "md5").alias("_new"))
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "changed")
    )
    return old.join(new, keys, "full_outer").select(*keys, change.alias("change")).where("change is not null")


def version_text(version: Column) -> Column:
    return F.concat_ws(".", *[version[part].cast("string") for part in ("major", "minor", "patch")])


def parse_version(text: Column) -> Column:
    """Comparable version from ``major.minor.patch`` text."""
    parts = F.split(text, r"\.")
    names = ("major", "minor", "patch")
    return F.struct(*[F.get(parts, F.lit(i)).cast("int").alias(n) for i, n in enumerate(names)])


def latest_versions(catalog: DataFrame) -> DataFrame:
    """The catalog row with the highest version of each package."""
    columns = [c for c in catalog.columns if c != "package_id"]
    newest = F.max_by(F.struct(*columns), F.struct(parse_version(F.col("version")), *columns))
    return (
        catalog.groupBy("package_id")
        .agg(newest.alias("_row"))
        .select("package_id", *[F.col(f"_row.{c}").alias(c) for c in columns])
    )


def bump_version(version: Column, component: str) -> Column:
    """Next version; a package without one starts at 1.0.0."""
    now = parse_version(version)
    if component not in ("Major", "Minor", "Patch"):
        raise ValueError(f"component must be Major, Minor or Patch, not {component!r}")
    raised = {
        "Major": F.struct(
            (now["major"] + 1).alias("major"), F.lit(0).alias("minor"), F.lit(0).alias("patch")
        ),
        "Minor": F.struct(
            now["major"].alias("major"), (now["minor"] + 1).alias("minor"), F.lit(0).alias("patch")
        ),
        "Patch": F.struct(
            now["major"].alias("major"),
            now["minor"].alias("minor"),
            (now["patch"] + 1).alias("patch"),
        ),
    }[component]
    return F.when(version.isNull(), F.lit("1.0.0")).otherwise(version_text(raised))


def next_catalog_rows(
    catalog: DataFrame, published: DataFrame, component: str, log_text: str, stamp: Column
) -> DataFrame:
    """Catalog rows for newly published packages: bumped version, time and change-log line.

    ``published`` has ``package_id`` and the columns to record, such as ``path``.
    """
    latest = latest_versions(catalog).select("package_id", F.col("version").alias("_version"))
    return (
        published.join(latest, "package_id", "left")
        .withColumn("version", bump_version(F.col("_version"), component))
        .withColumn("published_at", stamp)
        .withColumn("log_text", F.lit(log_text))
        .drop("_version")
    )
