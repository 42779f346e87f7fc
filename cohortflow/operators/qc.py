"""Quality results: attach them to run sheets, and sum them up over the libraries of a sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids, values


def merged_read_names(
    sheets: DataFrame, trimmed: bool = True, grouping: tuple[str, ...] = ("Sample_Name",)
) -> DataFrame:
    """Add the names result files are listed under: per library, and merged per sample.

    Trimmed libraries that are merged carry ``.trimmed``; ``grouping`` names what gets merged.
    """
    mark = ".trimmed" if trimmed else ""
    merged = F.concat_ws("_", *[F.col(column) for column in grouping])
    return sheets.withColumn(
        "library_file", F.concat(F.col("Library_ID"), F.lit(f"{mark}.bam"))
    ).withColumn("merged_file", F.concat(merged, F.lit(f"{mark}.bam")))


def restrict_qc(
    qc: DataFrame, sheets: DataFrame, on: str = "file", sheet_column: str = "merged_file"
) -> DataFrame:
    """Results of files that a run sheet lists."""
    listed = sheets.select(F.col(sheet_column).alias(on))
    return qc.join(listed, on, "left_semi")


def _summary_parts() -> list[Column]:
    """Smallest, largest and missing treatments show whether they differ; no list is gathered."""
    udg = F.col("UDG_Treatment")
    return [
        F.min(udg).alias("_low"),
        F.max(udg).alias("_high"),
        F.count(udg).alias("_known"),
        F.count(F.lit(1)).alias("_rows"),
    ]


def _summary_columns(capture: str, libraries: Column) -> dict[str, Column]:
    several = (F.col("_low") != F.col("_high")) | (
        (F.col("_known") > 0) & (F.col("_known") < F.col("_rows"))
    )
    labels = F.repeat(F.lit(f"{capture};"), (libraries - 1).cast("int"))
    return {
        "UDG": F.when(several, "mixed").otherwise(F.col("_low")),
        "Nr_Libraries": libraries,
        "Capture_Type": F.concat(labels, F.lit(capture)),
        "Library_Built": values.library_built(F.col("Strandedness")),
    }


def sample_summary(sheets: DataFrame, capture: str = V.CAPTURE_TYPE) -> DataFrame:
    """Per sample and strandedness: UDG treatment, library rows, capture labels, build.

    Different treatments (a missing one counts as a treatment) give ``mixed``.
    """
    grouped = sheets.groupBy("Sample_Name", "Strandedness").agg(*_summary_parts())
    columns = [column.alias(name) for name, column in _summary_columns(capture, F.col("_rows")).items()]
    return grouped.select("Sample_Name", "Strandedness", *columns)


def _left(sheets: DataFrame, table: DataFrame | None, key: str, columns: dict[str, str]):
    """Left join, or NULL columns of the given types where there is no table.

    A key reported more than once counts with the largest of its rows, compared column by column.
    """
    if table is None:
        return sheets.withColumns({name: F.lit(None).cast(t) for name, t in columns.items()})
    single = table.groupBy(key).agg(F.max(F.struct(*columns)).alias("_one"))
    return sheets.join(single, key, "left").select(
        *sheets.columns, *[F.col(f"_one.{name}").alias(name) for name in columns]
    )


def compile_qc(
    sheets: DataFrame,
    sexdet: DataFrame,
    snpcov: DataFrame,
    nuccont: DataFrame,
    damage: DataFrame | None = None,
    endogenous: DataFrame | None = None,
    xx: tuple[float, float, float, float] = V.XX_CUTOFFS,
    xy: tuple[float, float, float, float] = V.XY_CUTOFFS,
) -> DataFrame:
    """One row per sample and library with every quality result that exists for it.

    ``sexdet`` and ``snpcov`` are keyed by ``Sample_Name``; ``nuccont``, ``damage`` and
    ``endogenous`` by ``Library_ID``. Lanes of a library collapse first. Missing tables give NULL.
    """
    libraries = sheets.select("Sample_Name", "Library_ID", "Strandedness", "UDG_Treatment").distinct()
    joined = _left(
        libraries,
        sexdet,
        "Sample_Name",
        {"x_rate": "double", "x_err": "double", "y_rate": "double", "y_err": "double"},
    )
    joined = _left(joined, snpcov, "Sample_Name", {"covered_snps": "bigint"})
    joined = _left(
        joined,
        nuccont,
        "Library_ID",
        {"contamination": "double", "contamination_err": "double", "contamination_snps": "bigint"},
    )
    joined = _left(joined, damage, "Library_ID", {"damage": "double", "damage_reads": "bigint"})
    joined = _left(joined, endogenous, "Library_ID", {"endogenous": "double"})
    sex = F.when(
        F.col("x_rate").isNotNull(), values.classify_sex(F.col("x_rate"), F.col("y_rate"), xx, xy)
    )
    return joined.withColumn("Genetic_Sex", sex)


def usable(value: Column, snps: Column, cutoff: int) -> Column:
    """A contamination value, or NULL if it rests on fewer SNPs than the cutoff."""
    return F.when(snps >= cutoff, value)


def _weighted_mean(value: Column, weight: Column) -> Column:
    return F.try_divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def compile_across_libs(
    libraries: DataFrame,
    snp_cutoff: int = V.CONTAMINATION_SNP_CUTOFF,
    capture: str = V.CAPTURE_TYPE,
    anchored_names: bool = False,
) -> DataFrame:
    """Sample-level results from the library rows of ``compile_qc``.

    Contamination is weighted by SNPs and ignores libraries below the cutoff, damage is weighted
    by reads, endogenous DNA is the largest value. Libraries of different strandedness are never
    put together, as in ``sample_summary``. The two text columns that list libraries hold one
    entry per distinct library: that is the size of the field itself.
    """
    snps = F.col("contamination_snps")
    estimate = usable(F.col("contamination"), snps, snp_cutoff)
    error = usable(F.col("contamination_err"), snps, snp_cutoff)
    per_sample = libraries.groupBy("Sample_Name", "Strandedness").agg(
        *_summary_parts(),
        F.max("Genetic_Sex").alias("Genetic_Sex"),
        F.max("x_rate").alias("_x"),
        F.max("x_err").alias("_xe"),
        F.max("y_rate").alias("_y"),
        F.max("y_err").alias("_ye"),
        F.max("covered_snps").alias("Nr_SNPs"),
        F.max("endogenous").alias("Endogenous"),
        _weighted_mean(estimate, snps).alias("Contamination"),
        _weighted_mean(error, snps).alias("Contamination_Err"),
        _weighted_mean(F.col("damage"), F.col("damage_reads")).alias("Damage"),
        F.collect_set(F.struct("Library_ID", snps.alias("snps"))).alias("_libraries"),
    )
    listed = F.array_sort("_libraries")
    snp_list = F.array_join(
        F.transform(listed, lambda one: F.coalesce(one["snps"].cast("string"), F.lit("0"))), ";"
    )
    note = F.when(
        F.col("Contamination").isNotNull(),
        F.concat(
            F.lit(V.CONTAMINATION_NOTE[0]),
            snp_list,
            F.lit(V.CONTAMINATION_NOTE[1].format(cutoff=snp_cutoff)),
        ),
    ).otherwise(F.lit(V.NO_CONTAMINATION_NOTE))
    sex_note = F.when(
        F.col("_x").isNotNull(),
        F.format_string(
            V.SEX_NOTE,
            F.col("_x"),
            F.coalesce("_xe", F.lit(0.0)),
            F.col("_y"),
            F.coalesce("_ye", F.lit(0.0)),
        ),
    )
    names = F.transform(listed, lambda one: one["Library_ID"])
    # A library may come with several treatments; it is one library all the same.
    summary = _summary_columns(capture, F.size(F.array_distinct(names)).cast("long"))
    has_estimate = F.col("Contamination").isNotNull()
    return per_sample.select(
        "Sample_Name",
        "Genetic_Sex",
        sex_note.alias("Sex_Determination_Note"),
        "Nr_SNPs",
        "Endogenous",
        "Contamination",
        "Contamination_Err",
        note.alias("Contamination_Note"),
        F.when(has_estimate, "ANGSD").alias("Contamination_Meas"),
        "Damage",
        summary["UDG"].alias("UDG"),
        summary["Nr_Libraries"].alias("Nr_Libraries"),
        ids.clean_library_names(names, anchored_names).alias("Library_Names"),
        summary["Library_Built"].alias("Library_Built"),
        summary["Capture_Type"].alias("Capture_Type"),
    )


def enrich_across_types(
    target: DataFrame, other: DataFrame, columns: tuple[str, ...], on: str = "individual"
) -> DataFrame:
    """Give the samples of one analysis type values that another type measured for the individual.

    Several measurements of an individual count with the largest value of each column, as for the
    libraries of a sample.
    """
    largest = other.groupBy(on).agg(*[F.max(column).alias(column) for column in columns])
    return target.join(largest, on, "left")


def fill_across_types(
    samples: DataFrame, other: DataFrame, columns: tuple[str, ...], key: str = "Sample_Name", library: str = "Library_ID"
) -> DataFrame:
    """Samples whose own libraries have no value take the one that another analysis type has for the individual.

    ``other`` is keyed by library; samples and libraries are matched by the individual in their IDs.
    """
    measured = other.select(ids.individual_id(F.col(library)).alias("individual"), *columns)
    named = samples.withColumn("individual", ids.individual_id(F.col(key)))
    wanted = named.select("individual").distinct()
    found = enrich_across_types(wanted, measured, columns).withColumnsRenamed({c: f"_{c}" for c in columns})
    joined = named.join(found, "individual", "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}
    return joined.withColumns(filled).select(*samples.columns)
