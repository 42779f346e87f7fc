"""Writers of data packages, and staged publishing through a catalog that several publishers may add to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators import packages
from cohortflow.session import written
from cohortflow.sinks import commits
from cohortflow.sinks.tables import stamp_version, write_ind, write_metadata
from cohortflow.sources.files import SNP_COLUMNS

CATALOG_SCHEMA = (
    "package_id string, version string, path string, published_at timestamp, "
    "log_text string, producer_version string, digest string"
)
MANIFEST_SCHEMA = "package_id string, version string, name string, length bigint, n_blocks bigint, md5 string"


def write_package(
    lines: DataFrame, snps: DataFrame, inds: DataFrame, metadata: DataFrame, path: str
) -> None:
    """Write a package to a new path: ``geno``, ``snp``, ``ind`` and ``metadata``.

    ``lines`` has ``snp_idx, line``; ``snps`` ``snp_idx`` and the SNP columns; ``inds`` ``pos`` and
    the sample index columns. Each is range-sorted, so its parts in name order are the whole file.
    """
    lines.orderBy("snp_idx").select("line").write.text(f"{path}/geno")
    write_snps(snps, f"{path}/snp")
    write_ind(inds, f"{path}/ind", "EIGENSTRAT", order="pos")
    write_metadata(metadata, f"{path}/metadata")


def write_snps(snps: DataFrame, path: str) -> None:
    """SNP list in genome order, tab separated."""
    line = F.concat_ws("\t", *SNP_COLUMNS)
    snps.orderBy("snp_idx").select(line.alias("value")).write.text(path)


def read_catalog(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """All rows of the catalog, as of commit ``number`` or of now."""
    return commits.read(spark, path, "rows", CATALOG_SCHEMA, number)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of every published version, with their digests."""
    return commits.read(spark, path, "files", MANIFEST_SCHEMA)


def create_catalog(spark: SparkSession, path: str) -> None:
    """An empty catalog at a new path."""
    commits.create(spark, path)


def merge_catalog(spark: SparkSession, path: str) -> int:
    """Bring the rows of all commits together, so that readers need not open a folder per commit."""
    return commits.merge(spark, path, {"rows": CATALOG_SCHEMA, "files": MANIFEST_SCHEMA})


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _add_rows(
    spark: SparkSession,
    catalog_path: str,
    published: Callable[[DataFrame], DataFrame],
    component: str,
    log_text: str,
    stamp: Column | None,
    base: int | None,
    manifest: DataFrame | None = None,
) -> int:
    moment = F.current_timestamp() if stamp is None else stamp

    def make(number: int) -> dict[str, DataFrame]:
        catalog = read_catalog(spark, catalog_path, number)
        rows = packages.next_catalog_rows(catalog, published(catalog), component, log_text, moment)
        if manifest is None:
            return {"rows": stamp_version(rows.withColumn("digest", F.lit(None).cast("string"))).select(*_names(CATALOG_SCHEMA))}
        # Written once: versions of files and rows must be the same.
        rows = written(rows.join(packages.package_digests(manifest), "package_id", "left"), "catalog-rows")
        listed = manifest.join(rows.select("package_id", "version"), "package_id")
        return {
            "rows": stamp_version(rows).select(*_names(CATALOG_SCHEMA)),
            "files": listed.select(*_names(MANIFEST_SCHEMA)),
        }

    return commits.add(spark, catalog_path, make, base)


def publish_if_valid(
    staged: DataFrame,
    checks: DataFrame,
    catalog_path: str,
    component: str = "Major",
    log_text: str = "Update genotypes",
    stamp: Column | None = None,
    base: int | None = None,
    manifest: DataFrame | None = None,
) -> int:
    """Make the staged packages that pass every check the current ones, and return the number of the commit.

    ``staged`` has ``package_id, path`` of data already written aside. Publishing is one commit of pointer rows to the
    catalog; a package that fails keeps the version it had. Versions follow those of the commit worked from, the newest one unless
    ``base`` names one: if another publisher commits first, they are made anew, so no version is given twice.
    ``manifest`` (``packages.manifest``) is stored with the rows.
    """
    good = staged.join(packages.valid_packages(checks), "package_id", "left_semi")
    return _add_rows(
        staged.sparkSession, catalog_path, lambda _: good, component, log_text, stamp, base, manifest
    )


def append_changelog(
    catalog_path: str, ids: DataFrame, component: str, text: str, stamp: Column | None = None, base: int | None = None
) -> int:
    """Bump the version of the given packages and log why; their data stay where they are."""

    def same_place(catalog: DataFrame) -> DataFrame:
        current = packages.latest_versions(catalog).join(ids, "package_id", "left_semi")
        return current.select("package_id", "path")

    return _add_rows(ids.sparkSession, catalog_path, same_place, component, text, stamp, base)
