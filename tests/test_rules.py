"""Rules that the whole-table queries cannot show: odd IDs, broken files, repeated reports, other alleles."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from test_files import sheet
from test_run_sheets import ROWS, frames, protocols, runs

from cohortflow import fixed_values as V
from cohortflow.operators import genotypes, metadata, parameters, qc, reads, restriction
from cohortflow.operators.numbering import first_by_digest
from cohortflow.plans import prepare
from cohortflow.session import clear_scratch, scratch_root, shared_dir, written
from cohortflow.sinks import tables as sink
from cohortflow.sources import results, tables


@pytest.mark.parametrize("given", [True, False])
def test_other_individuals_of_a_site_stay(spark, tmp_path, given):
    path = str(tmp_path / "sheets")
    everyone = sheet(spark, "ABC001", "ABC002", "ABC003", "1AB001", "1AB002").withColumn(
        "site_id", F.when(F.col("target_ind").startswith("1"), "").otherwise("ABC")
    )
    sink.write_run_sheets(everyone, path, layout=sink.SITE_LAYOUT)
    again = everyone.filter("target_ind IN ('ABC002', '1AB002')").withColumn("Organism", F.lit("other"))
    previous = tables.read_run_sheets(spark, path, sink.SITE_LAYOUT) if given else None
    sink.write_run_sheets(again, path, previous, layout=sink.SITE_LAYOUT)
    back = tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)
    assert {(r.target_ind, r.site_id, r.Organism) for r in back.collect()} == {
        ("ABC001", "ABC", "human"), ("ABC002", "ABC", "other"), ("ABC003", "ABC", "human"),
        ("1AB001", "", "human"), ("1AB002", "", "other"),
    }


def test_headers_in_another_order_make_the_read_fail(spark, tmp_path):
    (tmp_path / "meta.tsv").write_text("id\tGroup_Name\tGenetic_Sex\na\tGroup\tF\n")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_metadata(spark, str(tmp_path / "meta.tsv"), ["id", "Genetic_Sex", "Group_Name"]).collect()
    good = tables.read_metadata(spark, str(tmp_path / "meta.tsv"), ["id", "Group_Name", "Genetic_Sex"])
    assert [tuple(r) for r in good.collect()] == [("a", "Group", "F")]


@pytest.mark.parametrize("text", ['{"s1": {"covered_snps": 1}', "[]", '{"s1": 5}'])
def test_broken_reports_are_named(spark, tmp_path, text):
    (tmp_path / "good.json").write_text('{"s1": {"covered_snps": 1}}')
    assert results.read_qc_json(spark, str(tmp_path), "snpcov").count() == 1
    (tmp_path / "broken.json").write_text(text)
    with pytest.raises(Exception, match="broken.json"):
        results.read_qc_json(spark, str(tmp_path), "snpcov").collect()
    listed = results.unreadable_reports(spark, str(tmp_path), "snpcov").collect()
    assert [os.path.basename(r.path) for r in listed] == ["broken.json"]


def test_listed_ids_lose_their_suffix_too(spark):
    rows = spark.createDataFrame([("ABC001",), ("ABC001_ss",), ("ABC002",), (None,)], "s string")
    listed = spark.createDataFrame([("ABC001_ss.A0101.TF1",)], "id string")
    assert {r.s for r in restriction.scrub(rows, listed, "s").collect()} == {"ABC002", None}
    files = spark.createDataFrame([("ABC001_ss", "TF", "input")], "individual string, analysis_type string, stage string")
    assert restriction.scrub_audit(listed, files).count() == 1


def test_no_restricted_row_is_written_down(spark):
    before = set(glob.glob(f"{scratch_root(spark)}/*"))
    listed = spark.createDataFrame([("ABC001.A0101",), ("ABC002.A0101",)], "id string")
    made = prepare.prepare_run_sheets(frames(spark, ROWS), runs(spark, "R1"), protocols(spark), listed)
    found = {r.target_ind for r in made.collect()}
    assert found and "ABC001" not in found
    after = set(glob.glob(f"{scratch_root(spark)}/*"))
    assert after - before
    for path in after - before:
        kept = spark.read.parquet(path)
        if "target_ind" in kept.columns:
            assert kept.filter("target_ind IN ('ABC001', 'ABC002')").isEmpty()


def test_scratch_is_the_applications_own_and_can_be_cleared(spark):
    written(spark.range(3), "gone")
    assert scratch_root(spark).startswith(shared_dir(spark)) and glob.glob(f"{scratch_root(spark)}/gone-*")
    clear_scratch(spark)
    assert not os.path.exists(scratch_root(spark))


def test_genome_order_of_text_chromosomes(spark):
    names = ["MT", "10", "2", "chr1", "X", "22", "Y", "9", "GL1"]
    snps = spark.createDataFrame(
        [("p", f"rs{n}", n, 0.0, 5, "A", "G") for n in names],
        "package_id string, snp_id string, chrom string, genetic_pos double, pos long, ref string, alt string",
    )
    merged = genotypes.merged_snps(snps).orderBy("snp_idx").collect()
    assert [r.chrom for r in merged] == ["chr1", "2", "9", "10", "22", "X", "Y", "MT", "GL1"]


def test_calls_follow_the_alleles_of_the_merged_list(spark):
    snps = spark.createDataFrame(
        [(p, s, "1", 0.0, n, *alleles) for p, s, n, alleles in [
            ("p", "s1", 1, "AG"), ("q", "s1", 1, "GA"), ("p", "s2", 2, "AC"), ("q", "s2", 2, "AT"), ("r", "s1", 1, "AG")]],
        "package_id string, snp_id string, chrom string, genetic_pos double, pos long, ref string, alt string",
    )
    inds = spark.createDataFrame([(p, f"{p}1") for p in "pqr"], "package_id string, sample_id string")
    genos = spark.createDataFrame(
        [(p, s, f"{p}1", c) for p, s, c in [("p", "s1", "2"), ("q", "s1", "2"), ("r", "s1", "1"), ("p", "s2", "0"), ("q", "s2", "0")]],
        "package_id string, snp_id string, sample_id string, call string",
    )
    lines, listed, _ = genotypes.forge(genos, snps, inds)
    assert [r.line for r in lines.orderBy("snp_idx").collect()] == ["201", "099"]
    changes = genotypes.allele_conflicts(snps, listed).collect()
    assert {(r.package_id, r.snp_id, r.change) for r in changes} == {("q", "s1", "swap"), ("q", "s2", "drop")}


SHEETS = "Sample_Name string, Library_ID string, Strandedness string, UDG_Treatment string"


def quality(spark, sheets, damage):
    none = "Sample_Name string, x_rate double, x_err double, y_rate double, y_err double"
    return qc.compile_qc(
        spark.createDataFrame(sheets, SHEETS),
        spark.createDataFrame([], none),
        spark.createDataFrame([("S", 10), ("S", 20)], "Sample_Name string, covered_snps bigint"),
        spark.createDataFrame([], "Library_ID string, contamination double, contamination_err double, contamination_snps bigint"),
        damage=spark.createDataFrame(damage, "Library_ID string, damage double, damage_reads bigint"),
    )


def test_repeated_reports_do_not_multiply_libraries(spark):
    rows = quality(spark, [("S", "L1", "double", "half")], [("L1", 0.1, 5), ("L1", 0.2, 7)])
    (row,) = rows.collect()
    assert (row.covered_snps, row.damage, row.damage_reads) == (20, 0.2, 7)
    (sample,) = qc.compile_across_libs(rows).collect()
    assert (sample.Nr_Libraries, sample.Library_Names, sample.Capture_Type) == (1, ["L1"], V.CAPTURE_TYPE)


def test_libraries_are_counted_not_rows(spark):
    rows = quality(spark, [("S", "L1", "double", "half"), ("S", "L1", "double", "none"), ("S", "L2", "double", "none")], [])
    (sample,) = qc.compile_across_libs(rows).collect()
    assert (sample.Nr_Libraries, sample.UDG) == (2, "mixed")


def test_a_sample_of_two_builds_keeps_one_metadata_row(spark):
    rows = quality(spark, [("S", "L1", "double", "half"), ("S", "L2", "Unknown", "none"), ("S", "L3", "Unknown", "none")], [])
    across = qc.compile_across_libs(rows)
    assert across.count() == 2
    meta = spark.createDataFrame([("S", 0), ("T", 0)], "id string, Nr_Libraries bigint")
    updated = metadata.update_metadata(meta, across, None, "id")
    assert {(r.id, r.Nr_Libraries) for r in updated.select("id", "Nr_Libraries").collect()} == {("S", 2), ("T", None)}
    assert updated.count() == 2


def test_several_measurements_of_an_individual_do_not_multiply_samples(spark):
    target = spark.createDataFrame([("A", "A1")], "individual string, sample string")
    other = spark.createDataFrame([("A", 0.1), ("A", 0.3)], "individual string, Endogenous double")
    rows = qc.enrich_across_types(target, other, ("Endogenous",)).collect()
    assert [tuple(r) for r in rows] == [("A", "A1", 0.3)]


def test_reads_of_a_library_under_two_types_stay_single(spark):
    specs = spark.createDataFrame(
        [("L", "TF", "double", "half"), ("L", "SG", "double", "none")],
        "library_id string, analysis_type string, strandedness string, udg string",
    )
    lengths = spark.createDataFrame(
        [("TF", "double", "half", 2, 2)],
        "analysis_type string, strandedness string, udg string, clip_left int, clip_right int",
    )
    typed = spark.createDataFrame([("L", "TF", "ACGTACGT", 10), ("L", "SG", "ACGTACGT", 10)], "library_id string, analysis_type string, seq string, pos int")
    cut = reads.clip_reads(typed, specs, lengths)
    assert {(r.analysis_type, r.seq, r.pos) for r in cut.collect()} == {("TF", "GTAC", 12), ("SG", "ACGTACGT", 10)}
    with pytest.raises(Exception, match="several clip lengths for library L"):
        reads.clip_reads(typed.drop("analysis_type"), specs, lengths).collect()
    same = lengths.unionByName(lengths.withColumns({"analysis_type": F.lit("SG"), "udg": F.lit("none")}))
    assert reads.clip_reads(typed.drop("analysis_type"), specs, same).count() == 2


def test_profiles_lie_over_each_other(spark):
    rows = parameters.default_profiles(
        spark, {"fasta": "/f", "snpcapture_bed": "/all"}, {"YC": {"snpcapture_bed": "/y", "anno_file": "/ya"}}
    )
    found = {(r.analysis_type, r.key): r.value for r in parameters.resolve_params(rows, parameters.profile_order(spark)).collect()}
    assert found["TF", "publish_dir_mode"] == V.BASE_PARAMETERS["publish_dir_mode"]
    assert (found["TF", "snpcapture_bed"], found["YC", "snpcapture_bed"]) == ("/all", "/y")
    # An explicit "no value" of a type beats the path of the site.
    assert found["SG", "snpcapture_bed"] is None and found["SG", "fasta"] == "/f"
    with pytest.raises(ValueError):
        parameters.default_profiles(spark, {"nowhere": "/x"})


def test_rows_without_a_key_are_sampled_too(spark):
    rows = spark.createDataFrame([("a", k) for k in range(30)] + [(None, k) for k in range(30)], "k string, v int")
    digest = F.md5(F.col("v").cast("string"))
    found = first_by_digest(rows, ["k"], digest, 5, bucket_rows=4).groupBy("k").count().collect()
    assert {(r.k, r["count"]) for r in found} == {("a", 5), (None, 5)}


def test_base_and_call_come_from_one_read(spark):
    bases = spark.createDataFrame(
        [("s", "1", 5, b, 40, 40, k) for k, b in enumerate("ACGTN")],
        "sample_id string, chrom string, pos int, base string, mapq int, baseq int, read_id int",
    )
    snps = spark.createDataFrame([("rs", "1", 5, "A", "T")], "snp_id string, chrom string, pos int, ref string, alt string")
    calls = {"A": "2", "T": "0"}
    for seed in "abcdefgh":
        for keep in (False, True):
            (row,) = reads.pseudo_haploid(bases, snps, seed=seed, keep_incongruent=keep).collect()
            assert row.base in ("ACGTN" if keep else "AT") and row.call == calls.get(row.base, V.MISSING_CALL)
