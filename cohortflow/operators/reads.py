"""Read tables: filtering, clipping, sampling, ratios and random calls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.operators.numbering import first_by_digest
from cohortflow.session import broadcast_if_small


def filter_reads(
    reads: DataFrame, min_quality: int = 0, min_length: int = 30
) -> tuple[DataFrame, DataFrame]:
    """Mapped reads that are good and long enough, and the unmapped reads."""
    good = (F.col("mapq") >= min_quality) & (F.length("seq") >= min_length)
    return reads.filter(F.col("is_mapped") & good), reads.filter(~F.col("is_mapped"))


def clip_reads(reads: DataFrame, specs: DataFrame, lengths: DataFrame) -> DataFrame:
    """Cut both read ends as the library's strandedness and treatment demand.

    ``specs`` has ``library_id, analysis_type, strandedness, udg``; ``lengths`` comes from
    ``clip_lengths``. Combinations without a length are not cut. The start moves with the left cut.
    Reads with an ``analysis_type`` are matched on it too; without one, a library whose types ask for
    different cuts makes the job fail, since no read could be cut rightly.
    A library may hold a large share of the reads: they are not shuffled if the libraries are few.
    """
    on = ["library_id", *(["analysis_type"] if "analysis_type" in reads.columns else [])]
    cut = F.struct(F.coalesce("clip_left", F.lit(0)), F.coalesce("clip_right", F.lit(0)))
    several = F.raise_error(F.concat(F.lit("several clip lengths for library "), F.col("library_id")))
    per_library = (
        specs.join(lengths, ["analysis_type", "strandedness", "udg"], "left")
        .groupBy(*on)
        .agg(F.min(cut).alias("_low"), F.max(cut).alias("_high"))
        .select(*on, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(several).alias("_cut"))
        .select(*on, F.col("_cut.col1").alias("clip_left"), F.col("_cut.col2").alias("clip_right"))
    )
    left = F.coalesce("clip_left", F.lit(0))
    right = F.coalesce("clip_right", F.lit(0))
    kept = F.greatest(F.length("seq") - left - right, F.lit(0))
    return (
        reads.join(broadcast_if_small(per_library), on, "left")
        .withColumn("seq", F.substr("seq", left + 1, kept))
        .withColumn("pos", F.col("pos") + left)
        .drop("clip_left", "clip_right")
    )


def downsample(
    reads: DataFrame, n: int, seed: str = "0", keys: Sequence[str] = ("library_id",)
) -> DataFrame:
    """At most ``n`` reads per library, the same ones each time; read IDs are unique per library.

    Reads without a library are a library of their own.
    """
    digest = F.md5(F.concat(F.col("read_id").cast("string"), F.lit(f"|{seed}")))
    return first_by_digest(reads, list(keys), digest, n)


def mt_nuc_ratio(reads: DataFrame, mt: str = "MT") -> DataFrame:
    """Mitochondrial and nuclear reads per library, and their ratio (NULL without nuclear reads)."""
    counted = reads.groupBy("library_id").agg(
        F.count_if(F.col("chrom") == mt).alias("mt_reads"),
        F.count_if(F.col("chrom") != mt).alias("nuclear_reads"),
    )
    ratio = F.try_divide(F.col("mt_reads"), F.col("nuclear_reads"))
    return counted.withColumn("mt_nuc_ratio", ratio)


def pseudo_haploid(
    bases: DataFrame,
    snps: DataFrame,
    min_map_quality: int = 25,
    min_base_quality: int = 30,
    seed: str = "0",
    keep_incongruent: bool = False,
) -> DataFrame:
    """One random call per sample and SNP: ``2`` reference, ``0`` alternative, ``9`` neither.

    The base of the read with the smallest seeded digest is taken, so results repeat. Bases that
    are neither allele are left out first unless ``keep_incongruent``.
    """
    good = bases.filter(
        (F.col("mapq") >= min_map_quality) & (F.col("baseq") >= min_base_quality)
    ).select("sample_id", "chrom", "pos", "base", "read_id")
    joined = good.join(snps.select("snp_id", "chrom", "pos", "ref", "alt"), ["chrom", "pos"])
    congruent = (F.col("base") == F.col("ref")) | (F.col("base") == F.col("alt"))
    if not keep_incongruent:
        joined = joined.filter(congruent)
    digest = F.md5(F.concat(F.col("read_id").cast("string"), F.lit(f"|{seed}")))
    call = (
        F.when(F.col("base") == F.col("ref"), 2).when(F.col("base") == F.col("alt"), 0).otherwise(1)
    )
    # 54 bits of the digest, then the base and the call, in one number: its minimum is kept by a hash
    # aggregation, which a minimum over text would not be.
    drawn = F.conv(F.substr(digest, F.lit(1), F.lit(14)), 16, 10).cast("long")
    packed = F.shiftleft(F.shiftright(drawn, 2), 9) + F.ascii("base") * 4 + call
    code = F.col("_d") % 4
    return (
        joined.groupBy("sample_id", "snp_id")
        .agg(F.min(packed).alias("_d"))
        .select(
            "sample_id",
            "snp_id",
            F.char(F.shiftright("_d", 2) % 128).alias("base"),
            F.when(code == 2, "2").when(code == 0, "0").otherwise(V.MISSING_CALL).alias("call"),
        )
    )


def sex_rates(
    coverage: DataFrame, keys: Sequence[str] = (), x: str = "X", y: str = "Y", mt: str = "MT"
) -> DataFrame:
    """X and Y rate: reads per target base on X and Y, relative to the autosomes.

    ``coverage`` comes from ``interval_coverage``; ``keys`` (such as the sample) keep rates apart.
    """
    chrom, reads, length = F.col("chrom"), F.col("n_reads"), F.col("length")

    def density(condition):
        return F.try_divide(F.sum(F.when(condition, reads)), F.sum(F.when(condition, length)))

    autosomes = ~chrom.isin(x, y, mt)
    summed = coverage.groupBy(*keys).agg(
        density(chrom == x).alias("_x"),
        density(chrom == y).alias("_y"),
        density(autosomes).alias("_autosomes"),
    )
    return summed.select(
        *keys,
        F.try_divide("_x", "_autosomes").alias("x_rate"),
        F.try_divide("_y", "_autosomes").alias("y_rate"),
    )
