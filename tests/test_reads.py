"""Reads, clipping, sampling, calls, and interval depth against brute force."""

import random

import pytest

from cohortflow.operators import coverage, reads

READS = "library_id string, read_id string, chrom string, pos long, mapq int, is_mapped boolean, seq string"


def test_filter(spark):
    rows = [
        ("l", "a", "1", 1, 0, True, "A" * 30),
        ("l", "b", "1", 1, 0, True, "A" * 29),
        ("l", "c", "1", 1, -1, True, "A" * 30),
        ("l", "d", None, None, 0, False, "A" * 10),
    ]
    kept, unmapped = reads.filter_reads(spark.createDataFrame(rows, READS))
    assert [r.read_id for r in kept.collect()] == ["a"]
    assert [r.read_id for r in unmapped.collect()] == ["d"]


def test_clip(spark):
    rows = [(lib, "r", "1", 100, 30, True, "ABCDEFGHIJ") for lib in ("half", "ss", "full", "other")]
    rows.append(("half", "short", "1", 5, 30, True, "ABC"))
    specs = spark.createDataFrame(
        [("half", "TF", "double", "half"), ("ss", "TF", "single", "none"), ("full", "TF", "double", "full")],
        "library_id string, analysis_type string, strandedness string, udg string",
    )
    lengths = spark.createDataFrame(
        [("TF", "double", "half", 2, 3), ("TF", "single", "none", 0, 0)],
        "analysis_type string, strandedness string, udg string, clip_left int, clip_right int",
    )
    found = reads.clip_reads(spark.createDataFrame(rows, READS), specs, lengths)
    assert {(r.library_id, r.read_id): (r.seq, r.pos) for r in found.collect()} == {
        ("half", "r"): ("CDEFG", 102),
        ("half", "short"): ("", 7),
        ("ss", "r"): ("ABCDEFGHIJ", 100),
        ("full", "r"): ("ABCDEFGHIJ", 100),
        ("other", "r"): ("ABCDEFGHIJ", 100),
    }


def test_downsample_repeats_itself(spark):
    rows = [("big", f"r{i}") for i in range(500)] + [("small", "r1")]
    df = spark.createDataFrame(rows, "library_id string, read_id string")
    first = {tuple(r) for r in reads.downsample(df, 40, "s").collect()}
    again = {tuple(r) for r in reads.downsample(df.repartition(5), 40, "s").collect()}
    other = {tuple(r) for r in reads.downsample(df, 40, "t").collect()}
    assert first == again and len(first) == 41 and first != other


def test_mt_ratio(spark):
    df = spark.createDataFrame(
        [("a", "MT"), ("a", "MT"), ("a", "1"), ("a", "X"), ("b", "MT")], "library_id string, chrom string"
    )
    assert {tuple(r) for r in reads.mt_nuc_ratio(df).collect()} == {("a", 2, 2, 1.0), ("b", 1, 0, None)}


def test_haploid_calls(spark):
    snps = spark.createDataFrame(
        [("rs1", "1", 10, "A", "G"), ("rs2", "1", 20, "C", "T")],
        "snp_id string, chrom string, pos long, ref string, alt string",
    )
    rows = [
        ("s", "r1", "1", 10, "A", 25, 30),
        ("s", "r2", "1", 10, "T", 25, 30),
        ("s", "r3", "1", 20, "T", 24, 30),
        ("s", "r4", "1", 20, "C", 25, 29),
        ("t", "r5", "1", 20, "T", 60, 60),
        ("t", "r6", "1", 11, "A", 60, 60),
    ]
    bases = spark.createDataFrame(
        rows, "sample_id string, read_id string, chrom string, pos long, base string, mapq int, baseq int"
    )
    found = {(r.sample_id, r.snp_id): (r.base, r.call) for r in reads.pseudo_haploid(bases, snps).collect()}
    assert found == {("s", "rs1"): ("A", "2"), ("t", "rs2"): ("T", "0")}
    kept = reads.pseudo_haploid(bases.filter("base = 'T'"), snps, keep_incongruent=True)
    assert {(r.sample_id, r.call) for r in kept.collect()} == {("s", "9"), ("t", "0")}


@pytest.mark.parametrize("bin_width", [1, 5, 64, 100_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_interval_depth(spark, seed, bin_width):
    rng = random.Random(seed)
    axis = [("s1", "1"), ("s1", "X"), ("s2", "1")]
    rows = []
    for i in range(400):
        sample, chrom = axis[0] if i % 3 == 0 else rng.choice(axis)
        start = 50 if i % 3 == 0 else rng.randrange(200)
        rows.append((sample, chrom, start, start + rng.randrange(12)))
    targets = []
    for _ in range(80):
        start = rng.randrange(300)
        targets.append((*rng.choice(axis), start, start + rng.randrange(1, 40)))
    targets += [("s2", "X", 5, 9), ("s1", "1", 0, 500), ("s1", "1", 0, 500)]
    schema = "sample string, chrom string, start long, end long"
    found = coverage.interval_coverage(
        spark.createDataFrame(rows, schema),
        spark.createDataFrame(targets, schema),
        by=["sample"],
        bin_width=bin_width,
    ).collect()

    def expected(sample, chrom, start, end):
        near = [(s, e) for a, c, s, e in rows if (a, c) == (sample, chrom) and e > s]
        touching = [(s, e) for s, e in near if s < end and e > start]
        depth = [sum(s <= p < e for s, e in touching) for p in range(start, end)]
        return len(touching), sum(d > 0 for d in depth), sum(depth)

    assert sorted((r.sample, r.chrom, r.start, r.end) for r in found) == sorted(targets)
    for r in found:
        assert (r.n_reads, r.covered, r.bases) == expected(r.sample, r.chrom, r.start, r.end)
        assert r.length == r.end - r.start
        assert r.breadth == pytest.approx(r.covered / r.length)
        assert r.mean_depth == pytest.approx(r.bases / r.length)


def test_depth_plan_has_no_pairwise_join(spark):
    schema = "chrom string, start long, end long"
    df = spark.createDataFrame([("1", 1, 5)], schema)
    plan = coverage.interval_coverage(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_sex_rates(spark):
    rows = [("1", 100, 1000), ("2", 300, 1000), ("X", 100, 1000), ("Y", 10, 100), ("MT", 9, 1)]
    df = spark.createDataFrame(rows, "chrom string, n_reads long, length long")
    assert tuple(reads.sex_rates(df).first()) == (0.5, 0.5)
