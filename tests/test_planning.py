"""File states, queue, packages, restriction and housekeeping."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids
from cohortflow.operators import housekeeping, packages, parameters, planning, restriction
from cohortflow.plans import changes
from cohortflow.sinks import commits

NOW = datetime(2024, 5, 1, 12)
FILE = "path string, modificationTime timestamp"


def at(hours):
    return NOW - timedelta(hours=hours)


def test_new_runs(spark):
    rows = [
        ("/r/Human_1240k/200101_A/s/x.bam", at(1)),
        ("/r/Human_1240k/200101_A/s/y.bam", at(2)),
        ("/r/Human_Shotgun/210101_B/x.bam", at(24)),
        ("/r/Human_Shotgun/210202_C/x.bam", at(24.1)),
        ("/r/Human_Shotgun/190101_D/x.bam", at(1)),
        ("/r/Human_Y/220101_E/x.stats", at(1)),
        ("/r/Else/220101_F/x.bam", at(1)),
    ]
    files = spark.createDataFrame(rows, FILE)
    found = planning.new_runs(files, F.lit(NOW), "/r")
    assert {tuple(r) for r in found.collect()} == {
        ("TF", "200101_A"),
        ("TM", "200101_A"),
        ("SG", "210101_B"),
    }


@pytest.mark.parametrize(
    "left, right, newer",
    [(2, 1, True), (1, 2, False), (1, 1, False), (None, 1, False), (1, None, True), (None, None, False)],
)
def test_newer_than(spark, left, right, newer):
    column = planning.newer_than(F.lit(left).cast("int"), F.lit(right).cast("int"))
    assert spark.range(1).select(column).first()[0] is newer


def test_pending_and_queue(spark):
    keyed = "analysis_type string, individual string, modificationTime timestamp"
    inputs = spark.createDataFrame(
        [("TF", "a", at(1)), ("TF", "b", at(3)), ("SG", "a", at(1)), ("TF", "c", at(2))], keyed
    )
    reports = spark.createDataFrame(
        [("TF", "a", at(2)), ("TF", "b", at(2)), ("TF", "c", at(2)), ("TF", "a", at(9))], keyed
    )
    pending = planning.pending_runs(inputs, reports)
    assert {(r.analysis_type, r.individual) for r in pending.collect()} == {("TF", "a"), ("SG", "a")}
    for limit in (0, 100):
        queue = planning.with_task_id(pending, ["analysis_type", "individual"], limit)
        assert [(r.task_id, r.analysis_type) for r in queue.orderBy("task_id").collect()] == [
            (1, "SG"),
            (2, "TF"),
        ]
    assert planning.task(queue, 2).first().individual == "a"
    assert planning.queue_size(queue).first()[0] == 2


def test_command_squeezes_blanks(spark):
    df = spark.createDataFrame([("/in/a.tsv",)], "path string")
    filled = planning.queue_command(df, {"extra": ""}, "run   {path} {extra} -w {path}.d {extra}")
    assert filled.first().command == "run /in/a.tsv -w /in/a.tsv.d"


def test_package_states(spark):
    single, double = V.SINGLE_GENOTYPES, V.DOUBLE_GENOTYPES
    rows = [
        ("no_geno", "report.html", at(1)),
        ("new_both", single, at(1)),
        ("new_both", double, at(1)),
        ("new_one", single, at(1)),
        ("old_both", single, at(1)),
        ("old_both", double, at(9)),
        ("old_one", double, at(1)),
        ("same", single, at(5)),
        ("lost_geno", single, at(9)),
    ]
    files = spark.createDataFrame(rows, "individual string, name string, modificationTime timestamp")
    existing = spark.createDataFrame(
        [("old_both", at(5)), ("old_one", at(5)), ("same", at(5)), ("lost_geno", None)],
        "individual string, modificationTime timestamp",
    )
    wanted = spark.createDataFrame(
        [(name,) for name in sorted({r[0] for r in rows} | {"no_dir"})], "individual string"
    )
    states = {r.individual: r.state for r in planning.plan_packages(wanted, files, existing).collect()}
    assert states == {
        "no_dir": "ERROR_NO_DIR",
        "no_geno": "ERROR_NO_GENO",
        "new_both": "CREATE_MIXED",
        "new_one": "CREATE_SINGLE",
        "old_both": "UPDATE_MIXED",
        "old_one": "UPDATE_SINGLE",
        "same": "NO_CHANGE",
        "lost_geno": "UPDATE_SINGLE",
    }
    assert set(states.values()) == set(planning.PACKAGE_STATES)


def test_restriction(spark):
    sensitive = spark.createDataFrame([("A.1.2",), ("A.3",), ("B",)], "id string")
    df = spark.createDataFrame([("A",), ("A_ss",), ("A.lib",), ("B1",), ("C",), (None,)], "s string")
    assert {r.s for r in restriction.scrub(df, sensitive, "s").collect()} == {"B1", "C", None}
    files = spark.createDataFrame(
        [("A", "TF", "input"), ("A", "TF", "output"), ("A", "SG", "input"), ("A", "XX", "input"), ("C", "TF", "input")],
        "individual string, analysis_type string, stage string",
    )
    audit = restriction.scrub_audit(sensitive, files)
    assert {(r.individual, r.analysis_type, r.stage) for r in audit.collect()} == {
        ("A", "TF", "input"),
        ("A", "TF", "output"),
        ("A", "SG", "input"),
    }


def test_processed(spark):
    files = spark.createDataFrame(
        [("TF", "/o/TF/ABC/ABC002/multiqc"), ("TF", "/o/TF/ABC/ABC001/multiqc"), ("SG", "/o/SG/ABC/ABC001/multiqc")],
        "analysis_type string, path string",
    )
    processed = housekeeping.processed_individuals(files)
    assert processed.count() == 3
    unique = housekeeping.unique_individuals(processed)
    assert [r[0] for r in unique.collect()] == ["ABC001", "ABC002"]
    types = spark.createDataFrame([(t,) for t in V.ANALYSIS_TYPES], "analysis_type string")
    counts = {r[0]: r[1] for r in housekeeping.processed_counts(files, types).collect()}
    assert counts == {**dict.fromkeys(V.ANALYSIS_TYPES, 0), "TF": 2, "SG": 1}


def test_purge_keeps_protected_names_as_whole_words(spark):
    names = ["work", "worker", "my.work", "1240k.imputed", "1240kximputed", "GTL_output", "qc", "pipeline_info"]
    files = spark.createDataFrame(
        [(i, "TF", f"/o/{i}/{name}") for i in ("A", "B") for name in names],
        "individual string, analysis_type string, path string",
    )
    listed = spark.createDataFrame([("A",), ("A",)], "id string")
    plan = housekeeping.purge_plan(listed, files, types=("TF",))
    assert sorted(r.path for r in plan.collect()) == ["/o/A/1240kximputed", "/o/A/qc", "/o/A/worker"]
    assert housekeeping.purge_plan(listed, files, types=("SG",)).isEmpty()
    caches = housekeeping.work_directories(listed, files)
    assert [r.path for r in caches.collect()] == ["/o/A/work"]


def test_versions(spark):
    catalog = spark.createDataFrame(
        [("a", "1.9.0", "x"), ("a", "1.10.0", "y"), ("b", "2.0.0", "z")],
        "package_id string, version string, path string",
    )
    latest = {r.package_id: r.version for r in packages.latest_versions(catalog).collect()}
    assert latest == {"a": "1.10.0", "b": "2.0.0"}
    published = spark.createDataFrame([("a", "p"), ("c", "q")], "package_id string, path string")
    for part, expected in (("Major", "2.0.0"), ("Minor", "1.11.0"), ("Patch", "1.10.1")):
        rows = packages.next_catalog_rows(catalog, published, part, "why", F.lit(NOW))
        assert {r.package_id: r.version for r in rows.collect()} == {"a": expected, "c": "1.0.0"}
    with pytest.raises(ValueError):
        packages.bump_version(F.lit("1.0.0"), "Huge")


def test_parameters(spark):
    rows = [
        ("base", "k", "1"),
        ("base", "keep", "x"),
        ("TF", "k", "2"),
        ("SG", "k", None),
        ("SG", "own", "y"),
    ]
    params = spark.createDataFrame(rows, "profile string, key string, value string")
    order = parameters.profile_order(spark, ("base",))
    found = {
        (r.analysis_type, r.key): r.value
        for r in parameters.resolve_params(params, order).collect()
    }
    assert found["TF", "k"] == "2" and found["SG", "k"] is None and found["RP", "k"] == "1"
    assert found["TF", "keep"] == "x" and ("TF", "own") not in found


def test_default_parameters(spark):
    params = parameters.resolve_params(
        parameters.default_profiles(spark), parameters.profile_order(spark)
    )
    found = {(r.analysis_type, r.key): r.value for r in params.collect()}
    assert {t for t, _ in found} == set(V.ANALYSIS_TYPES)
    assert found["YC", "run_genotyping"] == "false" and ("YC", "genotyping_tool") not in found
    assert found["IM", "genotyping_tool"] == "hc" and found["TF", "genotyping_tool"] == "pileupcaller"
    assert found["SG", "snpcapture_bed"] is None and ("TF", "snpcapture_bed") not in found
    clips = {
        (r.analysis_type, r.strandedness, r.udg): (r.clip_left, r.clip_right)
        for r in parameters.clip_lengths(params).collect()
    }
    assert len(clips) == 4 * len(V.ANALYSIS_TYPES)
    assert clips["TF", "single", "none"] == (0, 0) and clips["IM", "single", "none"] == (7, 7)
    assert clips["TF", "double", "half"] == (2, 2) and clips["TF", "double", "none"] == (7, 7)


def test_stamps_and_path_parts(spark):
    df = spark.createDataFrame([("/a/b/c.tsv",)], "p string")
    row = df.select(
        ids.date_stamp(F.lit(datetime(2024, 3, 9, 7, 5))),
        ids.path_part(F.col("p"), 2),
        ids.path_part(F.col("p"), -2),
        ids.path_part(F.col("p"), 9),
        ids.base_name(F.col("p"), ".tsv"),
        ids.base_name(F.col("p"), ".txt"),
    ).first()
    assert tuple(row) == ("240309_0705", "a", "b", None, "c", "c.tsv")


LISTING = "individual string, path string, modificationTime timestamp, length bigint"


def test_plans_follow_from_what_changed(spark, tmp_path):
    store, seen = str(tmp_path / "store"), []

    def plan(files):
        rows = files.groupBy("individual").agg(F.count("*").alias("n"), F.sum("length").alias("size"))
        seen.append(sorted(r.individual or "" for r in rows.collect()))
        return rows

    def refresh(*rows):
        listing = spark.createDataFrame([(i, p, NOW, n) for i, p, n in rows], LISTING)
        found = changes.refresh(spark, store, listing, ["individual"], plan, "individual string, n bigint, size bigint")
        return sorted((tuple(r) for r in found.collect()), key=str)

    first = [("a", "/a/1", 1), ("a", "/a/2", 0), ("b", "/b/1", 5), (None, "/x", 7)]
    assert refresh(*first) == [("a", 2, 1), ("b", 1, 5), (None, 1, 7)]
    assert refresh(*reversed(first)) == [("a", 2, 1), ("b", 1, 5), (None, 1, 7)]
    # Nothing changed, so nothing was planned and nothing stored.
    assert seen == [["", "a", "b"]] and commits.latest(spark, store) == 1
    assert refresh(("a", "/a/1", 1), ("a", "/a/2", 3), ("c", "/c/1", 1), (None, "/x", 7)) == [("a", 2, 4), ("c", 1, 1), (None, 1, 7)]
    assert seen[1:] == [["a", "c"]]
    # A file that now belongs to another individual changes both.
    assert refresh(("c", "/a/1", 1), ("a", "/a/2", 3), ("c", "/c/1", 1), (None, "/x", 7)) == [("a", 1, 3), ("c", 2, 2), (None, 1, 7)]
    assert seen[2:] == [["a", "c"]]
    assert refresh() == []
    assert refresh(("d", "/d", 1)) == [("d", 1, 1)]
