"""Genotype matrices: long form, packed blocks, text lines, pasting, and merging of packages.

A packed block holds the calls of some neighbouring samples at one SNP as bits of one number, one bit per call a sample may have. Blocks are
combined by a bitwise or, which Spark does before the shuffle; copies of a call do no harm, and exchanging the alleles of a
whole block is three bit operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.operators.numbering import number_rows, spread
from cohortflow.session import broadcast_if_small, written

# Bits per sample, and samples per packed block.
_BITS = len(V.GENOTYPE_CALLS)
BLOCK = 63 // _BITS


def packed_call(pos: Column, call: Column, block: int = BLOCK) -> Column:
    """The bit of a call in its sample's block; NULL for what is no call."""
    code = F.instr(F.lit("".join(V.GENOTYPE_CALLS)), call) - 1
    known = (F.length(call) == 1) & (code >= 0)
    shift = (pos % block * _BITS + code).cast("int")
    return F.when(known, F.call_function("shiftleft", F.lit(1).cast("long"), shift))


def block_text(bits: Column, missing: str = V.MISSING_CALL, block: int = BLOCK) -> Column:
    """The calls of a packed block; of several calls of one sample the first of ``GENOTYPE_CALLS``."""
    chosen = [V.GENOTYPE_CALLS[(k & -k).bit_length() - 1] if k else missing for k in range(1 << _BITS)]
    letters, mask = F.lit("".join(chosen)), F.lit((1 << _BITS) - 1).cast("long")
    one = [F.shiftright(bits, place * _BITS).bitwiseAND(mask).cast("int") + 1 for place in range(block)]
    return F.concat(*[F.substring(letters, place, F.lit(1)) for place in one])


def _mask(bits: int, block: int) -> Column:
    """The same bits of each sample of a block."""
    return F.lit(sum(bits << (place * _BITS) for place in range(block))).cast("long")


def exchanged(bits: Column, block: int = BLOCK) -> Column:
    """A packed block with the two alleles exchanged: ``0`` becomes ``2`` and ``2`` becomes ``0``.

    Of several calls of one sample only the first of ``GENOTYPE_CALLS`` is left before.
    """
    later = [F.shiftleft(bits.bitwiseAND(_mask((1 << (_BITS - far)) - 1, block)), far) for far in range(1, _BITS)]
    single = bits.bitwiseAND(F.bitwise_not(reduce(Column.bitwiseOR, later)))
    first, second = V.GENOTYPE_CALLS.index("0"), V.GENOTYPE_CALLS.index("2")
    low = _mask(1 << first, block)
    rest = _mask(((1 << _BITS) - 1) & ~(1 << first) & ~(1 << second), block)
    return (
        F.shiftleft(single.bitwiseAND(low), second - first)
        .bitwiseOR(F.shiftright(single, second - first).bitwiseAND(low))
        .bitwiseOR(single.bitwiseAND(rest))
    )


def paste_genotypes(double: DataFrame, single: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Line by line concatenation ``(snp_idx, line)``: double-stranded first, then single-stranded.

    ``keys`` (such as the package) allow many matrices at once. If one matrix is longer, the rest
    of its lines come alone (``unpaired_lines`` finds them).
    """
    left = double.select(*keys, "snp_idx", F.col("line").alias("_double"))
    right = single.select(*keys, "snp_idx", F.col("line").alias("_single"))
    joined = left.join(right, [*keys, "snp_idx"], "full_outer")
    pasted = F.concat(F.coalesce("_double", F.lit("")), F.coalesce("_single", F.lit("")))
    return joined.select(*keys, "snp_idx", pasted.alias("line"))


def unpaired_lines(double: DataFrame, single: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Line numbers that only one of the two matrices has."""
    sides = double.select(*keys, "snp_idx", F.lit(1).alias("side")).union(
        single.select(*keys, "snp_idx", F.lit(2).alias("side"))
    )
    found = sides.groupBy(*keys, "snp_idx").agg(
        F.min("side").alias("low"), F.max("side").alias("high")
    )
    only = F.when(F.col("low") == 1, "double").otherwise("single")
    return found.filter(F.col("low") == F.col("high")).select(
        *keys, "snp_idx", only.alias("only_in")
    )


def to_long(lines: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row ``(keys, snp_idx, pos, call)`` per character, ``pos`` counted from 0."""
    return lines.select(*keys, "snp_idx", F.posexplode(F.split("line", "")).alias("pos", "call"))


def to_geno_lines(
    calls: DataFrame,
    n_samples: int | Column,
    keys: Sequence[str] = (),
    missing: str = V.MISSING_CALL,
    block: int = BLOCK,
) -> DataFrame:
    """Text line of each SNP from calls ``(keys, snp_idx, pos, call)``; absent calls are ``missing``.

    Should a sample have several calls at one SNP, the smallest is taken; what is no genotype call is missing. Calls are packed
    and copies combined before the shuffle, so a line gathers one number per block and nothing else.
    """
    line, block = [*keys, "snp_idx"], min(block, BLOCK)
    place = F.floor(F.col("pos") / block).cast("int").alias("_block")
    packed = calls.groupBy(*line, place).agg(F.bit_or(packed_call(F.col("pos"), F.col("call"), block)).alias("_bits"))
    return _lines_of_blocks(packed, line, n_samples, missing, block)


def _lines_of_blocks(
    packed: DataFrame, line: Sequence[str], n_samples: int | Column, missing: str, block: int = BLOCK
) -> DataFrame:
    """Text lines from packed blocks ``(line, _block, _bits)``; a line without any block is all ``missing``."""
    width = F.lit(n_samples) if isinstance(n_samples, int) else n_samples
    text = F.struct("_block", block_text(F.coalesce("_bits", F.lit(0).cast("long")), missing, block).alias("_text"))
    lines = packed.groupBy(*line).agg(
        F.array_sort(F.collect_list(F.when(F.col("_block").isNotNull(), text))).alias("_texts")
    )
    whole = _join_blocks(F.col("_texts"), missing * block)
    return lines.select(*line, F.rpad(whole, width.cast("int"), F.lit(missing)).alias("line"))


def _join_blocks(texts: Column, empty: str) -> Column:
    """Sorted block texts as one text, with ``empty`` for every block that is left out."""

    def with_gap(text: Column, index: Column) -> Column:
        previous = F.when(index == 0, F.lit(-1)).otherwise(F.get(texts, index - 1)["_block"])
        return F.concat(F.repeat(F.lit(empty), text["_block"] - previous - 1), text["_text"])

    return F.array_join(F.transform(texts, with_gap), "")


def of_group(packages: DataFrame, group: str = "Unknown", column: str = "group") -> DataFrame:
    """Packages (or samples) with the group label a release is made of."""
    return packages.filter(F.col(column) == group)


def chromosome_rank(chrom: Column) -> Column:
    """Place in genome order: numbered chromosomes by number, then X, Y, the mitochondrion, and others."""
    name = F.upper(F.regexp_replace(chrom.cast("string"), "^(?i:chr)", ""))
    number = name.try_cast("int")
    return (
        F.when(number.isNotNull(), number)
        .when(name == "X", 1001)
        .when(name == "Y", 1002)
        .when(name.isin("MT", "M"), 1003)
        .otherwise(1004)
    )


def merged_snps(snps: DataFrame) -> DataFrame:
    """Union of the SNP lists of all packages, in genome order, with ``snp_idx`` from 0.

    A SNP that packages describe differently takes the smallest description; ``allele_conflicts`` says
    what that does to calls.
    """
    described = ["chrom", "pos", "genetic_pos", "ref", "alt"]
    # Descriptions are compared by sorting, and a file of SNPs may be read by one task.
    unique = (
        spread(snps.select("snp_id", *described), snps.count(), ["snp_id"])
        .groupBy("snp_id")
        .agg(F.min(F.struct(*described)).alias("_d"))
        .select("snp_id", *[F.col(f"_d.{name}").alias(name) for name in described])
    )
    ranked = unique.withColumn("_rank", chromosome_rank(F.col("chrom")))
    numbered = number_rows(ranked, [], ["_rank", "chrom", "pos", "snp_id"], "snp_idx")
    return numbered.withColumn("snp_idx", F.col("snp_idx") - 1).drop("_rank")


def allele_conflicts(snps: DataFrame, snp_list: DataFrame) -> DataFrame:
    """``package_id, snp_id, change`` where a package describes a SNP by other alleles than the merged list.

    ``swap``: the two alleles are exchanged, so are the calls. ``drop``: they are others, so the calls
    are missing. A package that lists a SNP twice counts with the change that keeps least.
    """
    merged = snp_list.select("snp_id", F.col("ref").alias("_ref"), F.col("alt").alias("_alt"))
    same = F.col("ref").eqNullSafe(F.col("_ref")) & F.col("alt").eqNullSafe(F.col("_alt"))
    swapped = F.col("ref").eqNullSafe(F.col("_alt")) & F.col("alt").eqNullSafe(F.col("_ref"))
    return (
        spread(snps, snps.count(), ["snp_id"])
        .join(merged, "snp_id")
        .filter(~same)
        .groupBy("package_id", "snp_id")
        .agg(F.when(F.bool_and(swapped), "swap").otherwise("drop").alias("change"))
    )


def merged_samples(inds: DataFrame) -> DataFrame:
    """Samples of all packages in package order, with ``pos`` from 0.

    A sample listed twice in a package takes the smallest of its entries.
    """
    rest = [c for c in inds.columns if c not in ("package_id", "sample_id")]
    unique = inds.select("package_id", "sample_id").distinct()
    if rest:
        unique = (
            inds.groupBy("package_id", "sample_id")
            .agg(F.min(F.struct(*rest)).alias("_rest"))
            .select("package_id", "sample_id", *[F.col(f"_rest.{c}").alias(c) for c in rest])
        )
    numbered = number_rows(unique, [], ["package_id", "sample_id"], "pos")
    return numbered.withColumn("pos", F.col("pos") - 1)


def forge(
    genos: DataFrame, snps: DataFrame, inds: DataFrame, missing: str = V.MISSING_CALL
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge packages into one data set: lines, SNP list and sample index.

    ``genos`` has ``package_id, snp_id, sample_id, call``, ``snps`` ``package_id`` and the SNP
    columns, ``inds`` ``package_id, sample_id`` and sample columns. Every SNP of any package is
    kept, calls a package lacks are ``missing``; no SNP by sample product is built. Calls follow the
    alleles of the merged list (``allele_conflicts``).
    """
    snp_list = written(merged_snps(snps), "snps")
    sample_list = written(merged_samples(inds), "samples")
    positions = broadcast_if_small(sample_list.select("package_id", "sample_id", "pos"))
    bit = packed_call(F.col("pos"), F.col("call").cast("string"))
    packed = (
        genos.join(positions, ["package_id", "sample_id"])
        .groupBy("package_id", "snp_id", F.floor(F.col("pos") / BLOCK).cast("int").alias("_block"))
        .agg(F.bit_or(bit).alias("_bits"))
    )
    bits = F.when(F.col("change") == "swap", exchanged(F.col("_bits"))).otherwise(F.col("_bits"))
    turned = (
        packed.join(allele_conflicts(snps, snp_list), ["package_id", "snp_id"], "left")
        .filter(F.col("change").isNull() | (F.col("change") == "swap"))
        .select("snp_id", "_block", bits.alias("_bits"))
    )
    # Blocks at the border of two packages have calls of both. SNPs that no package has called keep their line.
    merged = (
        snp_list.select("snp_id", "snp_idx")
        .join(turned, "snp_id", "left")
        .groupBy("snp_id", "snp_idx", "_block")
        .agg(F.bit_or("_bits").alias("_bits"))
    )
    n_samples = sample_list.agg(F.count(F.lit(1))).scalar()
    lines = _lines_of_blocks(merged, ["snp_id", "snp_idx"], n_samples, missing).drop("snp_id")
    return lines, snp_list, sample_list


def forge_lines(
    lines: DataFrame, snps: DataFrame, inds: DataFrame, missing: str = V.MISSING_CALL
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Merge packages that are text matrices, line by line, without taking lines apart.

    ``lines`` has ``package_id, snp_idx, line``, ``snps`` ``package_id, snp_idx`` and the SNP columns, ``inds``
    ``package_id, pos, sample_id`` and sample columns. Samples keep the order of their package, packages come in order of
    their ID, so a merged line is the lines of the packages one after the other. Only the samples that ``inds`` lists are taken
    over: a line of a package of which some are left out is cut to the others. Alleles are treated as by ``forge``;
    of a SNP that a package lists twice the line with the smallest position counts.
    """
    snp_list = written(merged_snps(snps.drop("snp_idx")), "snps")
    rest = [c for c in inds.columns if c not in ("package_id", "pos")]
    unique = inds.groupBy("package_id", "pos").agg(F.min(F.struct(*rest)).alias("_rest"))
    ordered = written(number_rows(unique, [], ["package_id", "pos"], "_place"), "samples")
    sample_list = ordered.select(
        "package_id", (F.col("_place") - 1).alias("pos"), *[F.col(f"_rest.{c}").alias(c) for c in rest]
    )
    # One row per package, with the places of its samples.
    members = written(
        ordered.groupBy("package_id").agg(
            (F.min("_place") - 1).alias("_from"),
            F.count(F.lit(1)).alias("_width"),
            F.array_sort(F.collect_list("pos")).alias("_kept"),
        ),
        "members",
    )
    wanted = snps.join(members.select("package_id"), "package_id", "left_semi")
    listed = wanted.groupBy("package_id", "snp_id").agg(F.min("snp_idx").alias("_line"))
    changes = allele_conflicts(wanted, snp_list)
    taken = listed.join(changes, ["package_id", "snp_id"], "left").filter(
        F.col("change").isNull() | (F.col("change") == "swap")
    )
    source = lines.select("package_id", F.col("snp_idx").alias("_line"), "line")
    whole = F.col("_kept")[F.col("_width").cast("int") - 1] == F.col("_width") - 1
    cut = F.array_join(F.transform("_kept", lambda at: F.substring("line", at.cast("int") + 1, F.lit(1))), "")
    text = F.when(whole, F.rpad("line", F.col("_width").cast("int"), F.lit(missing))).otherwise(cut)
    text = F.when(F.col("change") == "swap", F.translate(text, "02", "20")).otherwise(text)
    pieces = (
        taken.join(source, ["package_id", "_line"])
        .join(broadcast_if_small(members), "package_id")
        .select("snp_id", F.struct("_from", "_width", text.alias("_text")).alias("_piece"))
    )
    gathered = (
        snp_list.select("snp_id", "snp_idx")
        .join(pieces, "snp_id", "left")
        .groupBy("snp_id", "snp_idx")
        .agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    )
    n_samples = sample_list.agg(F.count(F.lit(1))).scalar().cast("int")
    merged = F.rpad(_join_pieces(F.col("_pieces"), missing), n_samples, F.lit(missing))
    return gathered.select("snp_idx", merged.alias("line")), snp_list, sample_list


def _join_pieces(pieces: Column, missing: str) -> Column:
    """Sorted texts of packages as one, with ``missing`` for the samples of packages in between."""

    def with_gap(piece: Column, index: Column) -> Column:
        previous = F.get(pieces, index - 1)
        end = F.when(index == 0, F.lit(0)).otherwise(previous["_from"] + previous["_width"])
        return F.concat(F.repeat(F.lit(missing), (piece["_from"] - end).cast("int")), piece["_text"])

    return F.array_join(F.transform(pieces, with_gap), "")
