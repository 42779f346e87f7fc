"""Genotype matrices and package checks."""

import random

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import genotypes, packages
from cohortflow.operators.numbering import spread


@pytest.mark.parametrize("block", [1, 4, 32])
def test_lines_from_sparse_calls(spark, block):
    rng = random.Random(3)
    width, height = 13, 20
    matrix = [[rng.choice("0129") for _ in range(width)] for _ in range(height)]
    rows = [
        (snp, pos, call)
        for snp, line in enumerate(matrix)
        for pos, call in enumerate(line)
        if call != "9" or rng.random() < 0.5
    ]
    rows += rows[:30]
    calls = spark.createDataFrame(rows, "snp_idx long, pos long, call string").repartition(5)
    lines = genotypes.to_geno_lines(calls, width, block=block)
    found = {r.snp_idx: r.line for r in lines.collect()}
    expected = {snp: "".join(line) for snp, line in enumerate(matrix)}
    assert found == {snp: expected[snp] for snp in found}
    assert set(found) == {r[0] for r in rows}


def test_long_form_is_the_inverse(spark):
    lines = spark.createDataFrame([(0, "019"), (1, "220")], "snp_idx long, line string")
    long = genotypes.to_long(lines)
    assert {tuple(r) for r in long.collect()} == {
        (0, 0, "0"), (0, 1, "1"), (0, 2, "9"), (1, 0, "2"), (1, 1, "2"), (1, 2, "0"),
    }
    assert genotypes.to_geno_lines(long, 3).exceptAll(lines).isEmpty()


def test_smallest_of_conflicting_calls_is_taken(spark):
    calls = spark.createDataFrame([(0, 0, "2"), (0, 0, "1"), (0, 1, "0")], "snp_idx long, pos long, call string")
    assert genotypes.to_geno_lines(calls, 2).first().line == "10"


def test_paste_puts_double_first(spark):
    schema = "package_id string, snp_idx long, line string"
    double = spark.createDataFrame([("p", 0, "0"), ("p", 1, "1"), ("q", 0, "2")], schema)
    single = spark.createDataFrame([("p", 0, "99"), ("p", 2, "00"), ("r", 0, "1")], schema)
    pasted = genotypes.paste_genotypes(double, single, ["package_id"])
    assert {tuple(r) for r in pasted.collect()} == {
        ("p", 0, "099"), ("p", 1, "1"), ("p", 2, "00"), ("q", 0, "2"), ("r", 0, "1"),
    }
    alone = genotypes.unpaired_lines(double, single, ["package_id"])
    assert {tuple(r) for r in alone.collect()} == {
        ("p", 1, "double"), ("p", 2, "single"), ("q", 0, "double"), ("r", 0, "single"),
    }


def test_forge_fills_what_packages_lack(spark):
    genos = spark.createDataFrame(
        [("p", "rs2", "a", "1"), ("p", "rs1", "a", "0"), ("q", "rs1", "b", "2"), ("q", "rs3", "c", "1")],
        "package_id string, snp_id string, sample_id string, call string",
    )
    snps = spark.createDataFrame(
        [(p, s, "1", 0.0, pos, "A", "G")
         for p in "pq" for s, pos in (("rs1", 30), ("rs2", 10), ("rs3", 20), ("rs4", 40))],
        "package_id string, snp_id string, chrom string, genetic_pos double, pos long, ref string, alt string",
    )
    inds = spark.createDataFrame(
        [("q", "c", "M"), ("p", "a", "F"), ("q", "b", "U"), ("q", "b", "U")],
        "package_id string, sample_id string, sex string",
    )
    lines, snp_list, samples = genotypes.forge(genos, snps, inds)
    assert [r.snp_id for r in snp_list.orderBy("snp_idx").collect()] == ["rs2", "rs3", "rs1", "rs4"]
    assert [(r.pos, r.sample_id) for r in samples.orderBy("pos").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    assert [r.line for r in lines.orderBy("snp_idx").collect()] == ["199", "991", "029", "999"]


@pytest.mark.parametrize("seed", [1, 2])
def test_forging_lines_and_calls_agree(spark, seed):
    """Random packages against merging by hand: missing SNPs, exchanged and other alleles, left-out samples."""
    rng = random.Random(seed)
    alleles = {f"rs{k}": ("A", "G") for k in range(12)}
    place = {snp: (rng.choice(["1", "X", "chr2", "MT", "weird"]), rng.randrange(5)) for snp in alleles}
    rank = {"1": 1, "chr2": 2, "X": 1001, "MT": 1003, "weird": 1004}
    order = sorted(alleles, key=lambda s: (rank[place[s][0]], *place[s], s))
    snps, lines, inds, genos, expected = [], [], [], [], {s: "" for s in alleles}
    for package in ("p1", "p2", "p3", "p4"):
        width = rng.randrange(1, 40)
        kept = [p for p in range(width) if package == "p3" or rng.random() < 0.8] or [0]
        inds += [(package, p, f"{package}-{p:03}", "U") for p in kept]
        for idx, snp in enumerate(rng.sample(sorted(alleles), 9)):
            change = None if package == "p1" else rng.choice([None, None, "swap", "drop"])
            ref, alt = {"swap": ("G", "A"), "drop": ("T", "Z")}.get(change, ("A", "G"))
            snps.append((package, idx, snp, place[snp][0], 0.0, place[snp][1], ref, alt))
            line = "".join(rng.choice("0129") for _ in range(width))
            lines.append((package, idx, line))
            genos += [(package, snp, f"{package}-{p:03}", line[p]) for p in range(width)]
            if change != "drop":
                line = line.translate(str.maketrans("02", "20")) if change else line
                expected[snp] += f"|{package}:" + "".join(line[p] for p in kept)
    sizes = {p: sum(i[0] == p for i in inds) for p in ("p1", "p2", "p3", "p4")}
    known = {snp for _, _, snp, *_ in snps}
    whole = []
    for snp in (s for s in order if s in known):
        have = dict(one.split(":") for one in expected[snp].split("|")[1:])
        whole.append("".join(have.get(p, "9" * n) for p, n in sizes.items()))
    # The merged list takes the smallest description: the first of ref and alt.
    described = {}
    for _, _, snp, *rest in snps:
        described[snp] = min(described.get(snp, tuple(rest)), tuple(rest))
    snp_schema = "package_id string, snp_idx long, snp_id string, chrom string, genetic_pos double, pos long, ref string, alt string"
    snps = [s for s in snps if described[s[2]][-2:] == ("A", "G")]
    fine = {s[2] for s in snps}
    whole = [line for line, snp in zip(whole, (s for s in order if s in known)) if snp in fine]
    snp_frame = spark.createDataFrame(snps, snp_schema)
    ind_frame = spark.createDataFrame(inds, "package_id string, pos long, sample_id string, sex string")
    line_frame = spark.createDataFrame(lines, "package_id string, snp_idx long, line string").repartition(3)
    geno_frame = spark.createDataFrame(
        [g for g in genos if g[1] in fine], "package_id string, snp_id string, sample_id string, call string"
    )
    merged, snp_list, samples = genotypes.forge_lines(line_frame, snp_frame, ind_frame)
    assert [r.snp_id for r in snp_list.orderBy("snp_idx").collect()] == [s for s in order if s in fine]
    assert [r.line for r in merged.orderBy("snp_idx").collect()] == whole
    assert [(r.package_id, r.sample_id) for r in samples.orderBy("pos").collect()] == [(p, s) for p, _, s, _ in inds]
    called, _, _ = genotypes.forge(geno_frame, snp_frame.drop("snp_idx"), ind_frame.drop("pos"))
    assert [r.line for r in called.orderBy("snp_idx").collect()] == whole


def test_exchanging_a_block_exchanges_each_call(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("0129") for _ in range(genotypes.BLOCK)) for _ in range(50)] + ["9" * genotypes.BLOCK]
    rows = [(k, p, c) for k, line in enumerate(texts) for p, c in enumerate(line)]
    calls = spark.createDataFrame(rows, "k long, pos long, call string")
    packed = calls.groupBy("k").agg(F.bit_or(genotypes.packed_call(F.col("pos"), F.col("call"))).alias("bits"))
    found = packed.select("k", genotypes.block_text(genotypes.exchanged(F.col("bits"))).alias("line")).collect()
    assert {r.k: r.line for r in found} == {k: t.translate(str.maketrans("02", "20")) for k, t in enumerate(texts)}


def test_the_smallest_call_is_taken_before_alleles_are_exchanged(spark):
    calls = spark.createDataFrame([(0, "2"), (0, "0"), (1, "1"), (1, "9"), (2, "2"), (2, "9")], "pos long, call string")
    packed = calls.agg(F.bit_or(genotypes.packed_call(F.col("pos"), F.col("call"))).alias("bits"))
    row = packed.select(genotypes.block_text(F.col("bits")), genotypes.block_text(genotypes.exchanged(F.col("bits")))).first()
    assert (row[0][:3], row[1][:3]) == ("012", "210")


def test_what_is_no_call_is_missing(spark):
    calls = spark.createDataFrame([(0, 0, "x"), (0, 1, "01"), (0, 2, None), (0, 3, ""), (0, 4, "2")], "snp_idx long, pos long, call string")
    assert genotypes.to_geno_lines(calls, 6).first().line == "999929"


def test_checks(spark):
    lines = spark.createDataFrame(
        [("good", "01"), ("good", "29"), ("short", "0"), ("short", "00"), ("odd", "0x"), ("more", "00")],
        "package_id string, line string",
    )
    snps = spark.createDataFrame(
        [("good", "1"), ("good", "2"), ("short", "1"), ("short", "2"), ("odd", "1"), ("more", "1"), ("more", "1")],
        "package_id string, snp_id string",
    )
    inds = spark.createDataFrame(
        [(p, s) for p in ("good", "short", "odd", "more") for s in "ab"] + [("none", "a")],
        "package_id string, sample_id string",
    )
    checks = packages.validate_package(lines, snps, inds)
    failed = {(r.package_id, r.check) for r in checks.filter("not ok").collect()}
    assert failed == {
        ("short", "samples_match_width"),
        ("odd", "calls_are_legal"),
        ("more", "snps_match_lines"),
        ("more", "snps_are_unique"),
        ("none", "samples_match_width"),
    }
    assert checks.filter(F.col("package_id") == "good").count() == len(packages.CHECKS)
    assert [r[0] for r in packages.valid_packages(checks).collect()] == ["good"]


def test_snps_of_one_file_are_not_sorted_by_the_task_that_reads_them(spark):
    """Descriptions are compared after the rows are dealt, by their number; allele changes need no sort."""
    rows = [("A", "r1", "1", 5, 0.0, "A", "G"), ("B", "r1", "1", 5, 0.0, "G", "A"), ("B", "r1", "1", 5, 0.0, "C", "A")]
    rows += [("B", "r2", "X", 1, 0.0, "G", "A"), ("A", "r2", "X", 1, 0.0, "A", "G"), ("A", "r3", "2", 9, 0.0, "A", None)]
    snps = spark.createDataFrame(
        rows, "package_id string, snp_id string, chrom string, pos int, genetic_pos double, ref string, alt string"
    ).coalesce(1)
    listed = genotypes.merged_snps(snps)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("SortAggregate") < plan.rindex("Exchange hashpartitioning(snp_id")
    assert sorted((r.snp_id, r.ref, r.alt, r.snp_idx) for r in listed.collect()) == [
        ("r1", "A", "G", 0), ("r2", "A", "G", 2), ("r3", "A", None, 1)
    ]
    changes = genotypes.allele_conflicts(snps, listed)
    # Of two entries for one SNP the change that keeps least counts.
    assert sorted(tuple(r) for r in changes.collect()) == [("B", "r1", "drop"), ("B", "r2", "swap")]


def test_rows_are_dealt_by_their_number(spark):
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(1000)
    assert spread(rows, 1000, ["id"]).rdd.getNumPartitions() == few
    dealt = spread(rows, 1000, ["id"], task_rows=20)
    assert dealt.rdd.getNumPartitions() == 50 and dealt.count() == 1000
