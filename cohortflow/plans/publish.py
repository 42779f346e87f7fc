"""Results to metadata, packages and releases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import values
from cohortflow.operators import genotypes, metadata, packages, qc, restriction
from cohortflow.sinks import packages as sink


def refresh_metadata(
    existing: DataFrame,
    sheets: DataFrame,
    sexdet: DataFrame,
    snpcov: DataFrame,
    nuccont: DataFrame,
    key: str,
    damage: DataFrame | None = None,
    endogenous: DataFrame | None = None,
    lab: DataFrame | None = None,
    shotgun: DataFrame | None = None,
    snp_cutoff: int = V.CONTAMINATION_SNP_CUTOFF,
    ploidy: str | None = V.GENOTYPE_PLOIDY,
) -> DataFrame:
    """Sample metadata with fresh result columns of all samples.

    ``sheets`` are the run sheet rows of the genotyped analysis type; ``sexdet`` is keyed by file
    and kept only where a sheet lists the file. ``damage`` and ``endogenous`` usually come from the
    shotgun results of the same libraries; ``shotgun`` (``Library_ID, Endogenous, Damage``) holds those of other libraries, which
    serve samples of the same individual that have no value of their own.
    """
    named = qc.merged_read_names(sheets)
    samples = named.select(F.col("merged_file").alias("file"), "Sample_Name").distinct()
    determined = qc.restrict_qc(sexdet, named).join(samples, "file").drop("file")
    libraries = qc.compile_qc(named, determined, snpcov, nuccont, damage, endogenous)
    results = qc.compile_across_libs(libraries, snp_cutoff)
    if shotgun is not None:
        results = qc.fill_across_types(results, shotgun, ("Endogenous", "Damage"))
    fresh = metadata.update_metadata(existing, results, lab, key)
    if ploidy is not None and "Genotype_Ploidy" in fresh.columns:
        fresh = values.fill_ploidy(fresh, ploidy)
    return fresh


def assemble_genotypes(double: DataFrame, single: DataFrame, plan: DataFrame) -> DataFrame:
    """Genotype lines ``(package_id, snp_idx, line)`` of the packages that are to be made anew.

    ``double`` and ``single`` hold the lines of all individuals by ``package_id``; ``plan`` has the
    state of each. Individuals with one kind of data keep that matrix as it is.
    """
    due = plan.filter(F.col("state").rlike("^(CREATE|UPDATE)_")).select(
        F.col("individual").alias("package_id")
    )
    return genotypes.paste_genotypes(
        double.join(due, "package_id", "left_semi"),
        single.join(due, "package_id", "left_semi"),
        ["package_id"],
    )


def publish_packages(
    staged: DataFrame,
    lines: DataFrame,
    snps: DataFrame,
    inds: DataFrame,
    catalog_path: str,
    sensitive: DataFrame | None = None,
    log_text: str = "Update genotypes",
    stamp: Column | None = None,
) -> DataFrame:
    """Check staged packages, publish the good ones with a manifest of their files, and return the check rows.

    Packages of restricted individuals are left out as well if ``sensitive`` is given.
    """
    checks = packages.validate_package(lines, snps, inds)
    if sensitive is not None:
        staged = restriction.scrub(staged, sensitive, "package_id")
    good = staged.join(packages.valid_packages(checks), "package_id", "left_semi")
    sink.publish_if_valid(
        staged, checks, catalog_path, log_text=log_text, stamp=stamp, manifest=packages.manifest(good)
    )
    return checks


def make_release(
    genos: DataFrame,
    snps: DataFrame,
    inds: DataFrame,
    sample_metadata: DataFrame,
    key: str,
    path: str,
    group: str = "Unknown",
    sensitive: DataFrame | None = None,
) -> None:
    """Merge the packages of a group into one data set and write it to a new path.

    ``inds`` has ``package_id, sample_id, sex, group``. ``genos`` are calls, or the text lines ``package_id, snp_idx, line`` of
    the packages, with ``snp_idx`` in ``snps`` and ``pos`` in ``inds``. In the release, the group label of samples
    and metadata comes from the sample ID.
    """
    chosen = genotypes.of_group(inds, group)
    if sensitive is not None:
        chosen = restriction.scrub(chosen, sensitive, "sample_id")
    members = chosen.select("package_id").distinct()
    merge = genotypes.forge_lines if "line" in genos.columns else genotypes.forge
    lines, snp_list, samples = merge(
        genos.join(members, "package_id", "left_semi"),
        snps.join(members, "package_id", "left_semi"),
        chosen,
    )
    index = metadata.regroup(samples, "sample_id", "group").select(
        "pos",
        F.col("sample_id").alias("Sample_Name"),
        F.col("sex").alias("Genetic_Sex"),
        F.col("group").alias("Population"),
    )
    listed = index.select(F.col("Sample_Name").alias(key))
    rows = sample_metadata.join(listed, key, "left_semi").select(*sample_metadata.columns)
    sink.write_package(lines, snp_list, index, metadata.regroup(rows, key, "Group_Name"), path)
