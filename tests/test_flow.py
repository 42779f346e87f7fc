"""A small lab through the whole flow: sheets, metadata, packages, release."""

import itertools

import pytest
from pyspark.sql import functions as F
from test_run_sheets import frames, protocols, runs

from cohortflow import fixed_values as V
from cohortflow.operators import genotypes, packages
from cohortflow.plans import prepare, publish
from cohortflow.sinks import packages as package_sink
from cohortflow.sources import files, tables

SITES = ("ABC", "DEF", "LONG")


@pytest.fixture(scope="module")
def lab_rows():
    """Three sites, twelve individuals, all analysis types, two runs each."""
    rows = []
    people = [f"{site}{number:03d}" for site in SITES for number in range(1, 5)]
    for (index, person), code in itertools.product(enumerate(people), V.ANALYSIS_TYPES):
        for lib in (1, 2):
            single = "yes" if lib == 2 and index % 2 else "no"
            library = f"{person}.A010{lib}"
            rows.append(
                (person, "", False, library, "P2" if single == "yes" else "P1",
                 V.PIPELINE_NAMES[code][lib - 1], "/d/", f"{library}.{code}1", f"R{lib}", single, False)
            )
    return rows


def test_sheets_of_all_types(spark, lab_rows):
    tables_ = frames(spark, lab_rows)
    sensitive = spark.createDataFrame([("DEF002.A0101.TF1",)], "id string")
    first = prepare.prepare_run_sheets(tables_, runs(spark, "R1"), protocols(spark), sensitive)
    rows = first.collect()
    assert {r.analysis_type for r in rows} == set(V.ANALYSIS_TYPES)
    assert {r.site_id for r in rows} == set(SITES)
    assert len({r.target_ind for r in rows}) == 11 and "DEF002" not in {r.target_ind for r in rows}
    lanes = {}
    for r in rows:
        lanes.setdefault((r.analysis_type, r.target_ind), []).append(r.Lane)
    assert all(sorted(found) == [1, 2] for found in lanes.values())
    again = prepare.prepare_run_sheets(tables_, runs(spark, "R2", "R1"), protocols(spark), sensitive)
    assert again.exceptAll(first).isEmpty() and first.exceptAll(again).isEmpty()


def test_metadata_of_all_samples(spark, lab_rows):
    sheets = prepare.prepare_run_sheets(
        frames(spark, lab_rows), runs(spark, "R1"), protocols(spark)
    ).filter("analysis_type = 'TF'")
    samples = [r.Sample_Name for r in sheets.select("Sample_Name").distinct().collect()]
    libraries = [r.Library_ID for r in sheets.select("Library_ID").distinct().collect()]
    sexdet = spark.createDataFrame(
        [(f"{s}.trimmed.bam", 1.0, 0.1, 0.05, 0.1) for s in samples] + [("x.bam", 1.0, 0.1, 0.0, 0.1)],
        "file string, x_rate double, x_err double, y_rate double, y_err double",
    )
    snpcov = spark.createDataFrame([(s, 1000) for s in samples], "Sample_Name string, covered_snps long")
    nuccont = spark.createDataFrame(
        [(lib, 0.25, 0.5, 200) for lib in libraries],
        "Library_ID string, contamination double, contamination_err double, contamination_snps long",
    )
    existing = spark.createDataFrame(
        [(s, "U", "Unknown", None) for s in [*samples, "ZZZ001"]],
        "sample string, Genetic_Sex string, Group_Name string, Genotype_Ploidy string",
    )
    lab = spark.createDataFrame([("ABC001", "cave")], "individual string, Location string")
    fresh = publish.refresh_metadata(existing, sheets, sexdet, snpcov, nuccont, "sample", lab=lab)
    rows = {r["sample"]: r for r in fresh.collect()}
    assert len(rows) == 19
    assert {r.Genetic_Sex for name, r in rows.items() if name != "ZZZ001"} == {"F"}
    assert rows["ZZZ001"].Genetic_Sex is None and rows["ZZZ001"].Group_Name == "Unknown"
    assert rows["ABC001"].Location == "cave" and rows["ABC001"].Nr_Libraries == 2
    assert rows["ABC002_ss"].Library_Built == "ss" and rows["ABC002_ss"].Library_Names == ["ABC002.A0102"]
    assert {r.Contamination for name, r in rows.items() if name != "ZZZ001"} == {0.25}
    assert {r.Genotype_Ploidy for r in rows.values()} == {"haploid"}

    # Shotgun libraries of the same individuals, some of them measured twice.
    shotgun = spark.createDataFrame(
        [("ABC001.A0301", 0.2, 0.1), ("ABC001.A0302", 0.4, None), ("QQQ001.A0301", 0.9, 0.9)],
        "Library_ID string, Endogenous double, Damage double",
    )
    filled = publish.refresh_metadata(existing, sheets, sexdet, snpcov, nuccont, "sample", lab=lab, shotgun=shotgun)
    assert filled.columns == fresh.columns
    found = {r["sample"]: (r.Endogenous, r.Damage) for r in filled.collect()}
    assert found["ABC001"] == (0.4, 0.1)
    assert {v for name, v in found.items() if not name.startswith("ABC001")} == {(None, None)}


def test_packages_and_release(spark, tmp_path):
    schema = "package_id string, snp_idx long, line string"
    double = spark.createDataFrame(
        [(p, i, call) for p, calls in (("ABC001", "02"), ("DEF001", "20"), ("DEF002", "29")) for i, call in enumerate(calls)],
        schema,
    )
    single = spark.createDataFrame([("ABC001", 0, "9"), ("ABC001", 1, "0")], schema)
    plan = spark.createDataFrame(
        [("ABC001", "CREATE_MIXED"), ("DEF001", "UPDATE_SINGLE"), ("DEF002", "NO_CHANGE")],
        "individual string, state string",
    )
    lines = publish.assemble_genotypes(double, single, plan)
    assert {(r.package_id, r.snp_idx, r.line) for r in lines.collect()} == {
        ("ABC001", 0, "09"), ("ABC001", 1, "20"), ("DEF001", 0, "2"), ("DEF001", 1, "0"),
    }
    inds = spark.createDataFrame(
        [("ABC001", 0, "ABC001", "F", "Unknown"), ("ABC001", 1, "ABC001_ss", "F", "Unknown"), ("DEF001", 0, "DEF001", "M", "Unknown")],
        "package_id string, pos long, sample_id string, sex string, group string",
    )
    snps = spark.createDataFrame(
        [(p, s, "1", 0.0, at, "A", "G") for p in ("ABC001", "DEF001") for s, at in (("rs1", 10), ("rs2", 20))],
        "package_id string, snp_id string, chrom string, genetic_pos double, pos long, ref string, alt string",
    )
    catalog = str(tmp_path / "catalog")
    package_sink.create_catalog(spark, catalog)
    staged = spark.createDataFrame([("ABC001", "/s/a"), ("DEF001", "/s/d")], "package_id string, path string")
    sensitive = spark.createDataFrame([("DEF001.A1",)], "id string")
    checks = publish.publish_packages(staged, lines, snps, inds, catalog, sensitive)
    assert checks.filter("not ok").isEmpty()
    live = packages.latest_versions(package_sink.read_catalog(spark, catalog))
    assert [(r.package_id, r.version) for r in live.collect()] == [("ABC001", "1.0.0")]

    long = lines.select("package_id", "snp_idx", F.posexplode(F.split("line", "")).alias("pos", "call"))
    genos = long.join(inds, ["package_id", "pos"]).select(
        "package_id", F.concat(F.lit("rs"), F.col("snp_idx") + 1).alias("snp_id"), "sample_id", "call"
    )
    meta = spark.createDataFrame(
        [("ABC001", "x"), ("ABC001_ss", "x"), ("DEF001", "x"), ("OLD001", "x")], "sample string, Group_Name string"
    )
    path = str(tmp_path / "release")
    publish.make_release(genos, snps, inds.drop("pos"), meta, "sample", path)
    geno = files.read_geno(spark, f"{path}/geno").orderBy("snp_idx").collect()
    index = files.read_positioned_ind(spark, f"{path}/ind").orderBy("pos").collect()
    assert [r.line for r in geno] == ["092", "200"]
    assert [(r.Sample_Name, r.Population) for r in index] == [
        ("ABC001", "ABC"), ("ABC001_ss", "ABC"), ("DEF001", "DEF"),
    ]
    written = tables.read_metadata(spark, f"{path}/metadata", ["sample", "Group_Name"])
    assert {tuple(r) for r in written.collect()} == {("ABC001", "ABC"), ("ABC001_ss", "ABC"), ("DEF001", "DEF")}
    assert genotypes.to_long(files.read_geno(spark, f"{path}/geno")).count() == 6
    # The same from the lines of the packages, without taking them apart.
    placed = snps.withColumn("snp_idx", F.when(F.col("snp_id") == "rs1", 0).otherwise(1).cast("long"))
    whole = str(tmp_path / "whole")
    publish.make_release(lines, placed, inds, meta, "sample", whole)
    assert [r.line for r in files.read_geno(spark, f"{whole}/geno").orderBy("snp_idx").collect()] == ["092", "200"]
    scrubbed = str(tmp_path / "scrubbed")
    publish.make_release(genos, snps, inds.drop("pos"), meta, "sample", scrubbed, sensitive=sensitive)
    left = files.read_positioned_ind(spark, f"{scrubbed}/ind")
    assert {r.Sample_Name for r in left.collect()} == {"ABC001", "ABC001_ss"}
