"""Consent, cohorts and run sheets on a small lab."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions import ids, values
from cohortflow.operators import cohorts, lims, numbering, run_sheets
from cohortflow.plans import prepare

# individual, main, consent, library, protocol, pipeline, directory, sequencing, run, single, exclude
ROWS = [
    ("ABC001", "", False, "ABC001.A0101", "P1", "HUMAN_1240K", "/old/d/", "ABC001.A0101.TF1", "R1", "no", False),
    ("ABC001", "", False, "ABC001.A0102", "P2", "Human_1240k", "/new/d/", "ABC001.A0102.TF1", "R2", "yes", None),
    ("ABC001", "", False, "ABC001.A0101", "P1", "Human_1240k", "/new/e/", "ABC001.A0101.TF2", "R3", "no", False),
    ("ABC001", "", False, "ABC001.A0103", "P1", "Human_1240k", None, "ABC001.A0103.TF1", "R1", "no", False),
    ("ABC002", "ABC001", False, "ABC002.B0101", "P9", "Human_1240k", "/new/d/", "ABC002.B0101.TF1", "R1", None, False),
    ("ABC003", "ABC001", False, "ABC003.B0101", "P1", "Human_1240k", "/new/d/", "ABC003.B0101.TF1", "R4", "no", False),
    ("ABC004", "", True, "ABC004.A0101", "P1", "Human_1240k", "/new/d/", "ABC004.A0101.TF1", "R1", "no", False),
    ("ABC005", "", None, "ABC005.A0101", "P1", "Human_1240k", "/new/d/", "ABC005.A0101.TF1", "R1", "no", False),
    ("ABC006", "", False, "ABC006.A0101", "P1", "Human_1240k", "/new/d/", "ABC006.A0101.TF1", "R1", "no", True),
    ("LONG007", None, False, "LONG007.A0101", "P3", "Human_1240k", "/new/d/", "LONG007.A0101.TF1", "R1", "yes", False),
    ("ABC008", "", False, "ABC008", "P3", "Human_Shotgun", "/new/d/", "ABC008.SG1", "R1", "yes", False),
    ("ABC009", "", False, "ABC009.A0101", "P1", "Foreign", "/new/d/", "ABC009.A0101.SG1", "R1", "no", False),
]
PROTOCOLS = [("P1", "double", "half"), ("P2", "single", "Unknown"), ("P3", "double", "Unknown")]


def lab(rows, deleted=()):
    """The ten tables, with one row of each level per row of ``rows`` below the individuals."""
    people = sorted({(r[0], r[1], r[2]) for r in rows}, key=str)
    number = {name: i for i, (name, _, _) in enumerate(people)}
    n = range(len(rows))
    return {
        "site": ([(1, "ABC")], "id long, name string"),
        "batch": ([(1, "b1")], "id long, name string"),
        "individual": (
            [(number[p], 1, p, main, "Homo sapiens") for p, main, _ in people],
            "id long, site long, full_individual_id string, main_individual_id string, organism string",
        ),
        "sample": (
            [(number[p], number[p], consent) for p, _, consent in people],
            "id long, individual long, ethically_culturally_sensitive boolean",
        ),
        "extract": ([(number[p], number[p]) for p, _, _ in people], "id long, sample long"),
        "library": (
            [(i, number[rows[i][0]], rows[i][3], rows[i][4]) for i in n],
            "id long, extract long, full_library_id string, protocol string",
        ),
        "capture": ([(i, i) for i in n], "id long, library long"),
        "sequencing": (
            [(i, i, 1, f"s{i}", rows[i][8], rows[i][7], rows[i][9], rows[i][10]) for i in n],
            "id long, capture long, batch long, sequencing_id string, run_id string, "
            "full_sequencing_id string, single_stranded string, exclude boolean",
        ),
        "raw_data": ([(i, i) for i in n], "id long, sequencing long"),
        "analysis": (
            [(i, rows[i][5], rows[i][6], "true" if i in deleted else "false") for i in n],
            "raw_data long, analysis_id string, result_directory string, deleted string",
        ),
    }


def frames(spark, rows=ROWS, deleted=()):
    return {
        name: spark.createDataFrame(data, schema)
        for name, (data, schema) in lab(rows, deleted).items()
    }


def runs(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "run_id string")


def protocols(spark):
    return spark.createDataFrame(PROTOCOLS, "protocol string, strandedness string, udg string")


def sheet(spark, *names, rows=ROWS, **options):
    return prepare.prepare_run_sheets(
        frames(spark, rows), runs(spark, *names), protocols(spark), **options
    )


def test_flat_joins_all_tables_and_drops_deleted(spark):
    assert lims.lims_flat(frames(spark)).count() == len(ROWS)
    assert lims.lims_flat(frames(spark, deleted=(0, 3))).count() == len(ROWS) - 2


def test_flat_demands_site_and_batch(spark):
    tables = frames(spark)
    assert lims.lims_flat({**tables, "site": tables["site"].filter("id > 1")}).isEmpty()
    assert lims.lims_flat({**tables, "batch": tables["batch"].filter("id > 1")}).isEmpty()


def test_both_pipeline_spellings_and_no_foreign_ones(spark):
    flat = lims.lims_flat(frames(spark), "TF")
    assert {r.analysis_id for r in flat.collect()} == {"HUMAN_1240K", "Human_1240k"}
    typed = lims.with_analysis_type(lims.lims_flat(frames(spark)))
    assert {r.analysis_type for r in typed.collect()} == {"TF", "SG"}


def test_type_arguments_are_checked(spark):
    with pytest.raises(ValueError, match="accepted: TF, TM, SG"):
        lims.check_type("XX")
    df = spark.createDataFrame([("TF",), ("xx",), (None,)], "analysis_type string")
    assert {r[0] for r in lims.invalid_types(df).collect()} == {"xx", None}


def test_consent_drops_unknown_and_exclude_keeps_unknown(spark):
    cases = [(c, e) for c in (True, False, None) for e in (True, False, None)]
    df = spark.createDataFrame(cases, "ethically_culturally_sensitive boolean, exclude boolean")
    kept = lims.not_excluded(lims.consented(df)).collect()
    assert {tuple(r) for r in kept} == {(False, False), (False, None)}


def test_canonical_id(spark):
    df = spark.createDataFrame([("f", "m"), ("f", ""), ("f", None)], "full string, main string")
    strict = ids.canonical_id(F.col("full"), F.col("main"))
    lenient = ids.canonical_id(F.col("full"), F.col("main"), null_main_is_missing=True)
    assert [tuple(r) for r in df.select(strict, lenient).collect()] == [
        ("m", "m"),
        ("f", "f"),
        (None, "f"),
    ]


def test_cohort_takes_all_runs_of_touched_full_ids_only(spark):
    flat = lims.lims_flat(frames(spark))
    found = cohorts.expand_cohort(flat, "R1")
    by_person = {r[0]: r[1] for r in found.groupBy("full_individual_id").count().collect()}
    # ABC001 comes with its rows of all runs; ABC003 shares the main ID but was not in the run.
    assert by_person["ABC001"] == 4
    assert "ABC003" not in by_person
    wide = cohorts.expand_cohort(flat, "R1", by="canonical")
    assert wide.filter("full_individual_id = 'ABC003'").count() == 1
    with pytest.raises(ValueError):
        cohorts.expand_cohort(flat, "R1", by="other")


def test_main_ids_of_the_run_pull_in_their_individual(spark):
    """R4 touches ABC003 only, whose main ID ABC001 brings that individual's rows along."""
    found = cohorts.expand_cohort(lims.lims_flat(frames(spark)), "R4")
    assert {r.full_individual_id for r in found.collect()} == {"ABC003", "ABC001"}


def test_policies_for_many_runs(spark):
    rows = prepare.cohort_rows(frames(spark), runs(spark, "R1", "R4"))
    assert {"ABC001", "ABC002", "ABC003"} <= {r.full_individual_id for r in rows.collect()}
    last = prepare.cohort_rows(frames(spark), runs(spark, "R1", "R4"), policy="last_run")
    of_target = last.filter("full_individual_id like 'ABC00_' and analysis_type = 'TF'")
    # Run R4 is handled last and rewrites the sheet of ABC001 without ABC002.
    assert {r.full_individual_id for r in of_target.collect()} == {"ABC001", "ABC003"}
    with pytest.raises(ValueError):
        prepare.cohort_rows(frames(spark), runs(spark, "R1"), policy="first")


@pytest.mark.parametrize("limit", [0, 1000])
def test_sheet_rows(spark, limit):
    found = sheet(spark, "R1", rebase=("/old/", "/new/"), limit=limit)
    rows = found.filter("target_ind = 'ABC001'").orderBy("Lane").collect()
    assert [
        (r.Sample_Name, r.Library_ID, r.Lane, r.Strandedness, r.UDG_Treatment, r.BAM) for r in rows
    ] == [
        ("ABC001", "ABC001.A0101", 1, "double", "half", "/new/d/ABC001.A0101.TF1.bam"),
        ("ABC001", "ABC001.A0101", 2, "double", "half", "/new/e/ABC001.A0101.TF2.bam"),
        ("ABC001_ss", "ABC001_ss.A0102", 3, "single", "none", "/new/d/ABC001.A0102.TF1.bam"),
        ("ABC001", "ABC002.B0101", 4, "Unknown", "Unknown", "/new/d/ABC002.B0101.TF1.bam"),
    ]
    assert {(r.site_id, r.Colour_Chemistry, r.SeqType, r.R1, r.R2) for r in rows} == {
        ("ABC", 4, "SE", None, None)
    }


def test_unknown_main_id_has_no_sheet(spark):
    named, unnamed = run_sheets.reject_unnamed(sheet(spark, "R1"))
    assert [r.Library_ID for r in unnamed.collect()] == ["LONG007_ss.A0101"]
    assert {r.target_ind for r in named.collect()} == {"ABC001", "ABC008"}
    report = run_sheets.prepare_report(sheet(spark, "R1")).collect()
    assert {tuple(r) for r in report} == {("TF", 2), ("SG", 1)}


def test_conflict_between_flag_and_protocol(spark):
    """ABC008 is flagged single-stranded but its protocol is not; LONG007 has no name to compare."""
    found = run_sheets.strandedness_conflicts(sheet(spark, "R1")).collect()
    assert {r.Library_ID for r in found} == {"ABC008"}


def test_copies_from_repeated_analyses_collapse(spark):
    rows = [*ROWS, ROWS[0]]
    tables = frames(spark, rows)
    # The copy is a second analysis entry of the same sequencing.
    analysis = tables["analysis"].withColumn(
        "raw_data", F.when(F.col("raw_data") == len(ROWS), 0).otherwise(F.col("raw_data"))
    )
    found = prepare.prepare_run_sheets(
        {**tables, "analysis": analysis}, runs(spark, "R1"), protocols(spark)
    )
    assert found.filter("target_ind = 'ABC001'").count() == 4


def test_rename_keeps_keys(spark):
    renamed = sheet(spark, "R1", rename=True)
    assert renamed.columns[:3] == ["analysis_type", "site_id", "target_ind"]
    assert {r.Library_ID for r in renamed.collect()} == {
        "ABC001_A0101",
        "ABC001_ss_A0102",
        "ABC002_B0101",
        "LONG007_ss_A0101",
        "ABC008",
    }


def test_whitelist_and_restriction(spark):
    listed = spark.createDataFrame([("ABC008",)], "id string")
    assert {r.target_ind for r in sheet(spark, "R1", whitelist=listed).collect()} == {"ABC008"}
    sensitive = spark.createDataFrame([("ABC001.A0101.TF1",), ("ABC001.A9",)], "id string")
    assert {r.target_ind for r in sheet(spark, "R1", sensitive=sensitive).collect()} == {
        "ABC008",
        None,
    }


def test_runs_of_one_analysis_type(spark):
    """Run R1 was found for shotgun data only, so it prepares no other sheets."""
    found = spark.createDataFrame([("SG", "R1"), ("TF", "R9")], "analysis_type string, run_id string")
    made = prepare.prepare_run_sheets(frames(spark), found, protocols(spark))
    assert {(r.analysis_type, r.target_ind) for r in made.collect()} == {("SG", "ABC008")}


def test_flags_as_text(spark):
    tables = frames(spark)
    words = F.when(F.col("exclude"), "yes").when(~F.col("exclude"), "no")
    spelled = tables["sequencing"].withColumn("exclude", words)
    made = prepare.prepare_run_sheets(
        {**tables, "sequencing": spelled}, runs(spark, "R1"), protocols(spark)
    )
    assert made.exceptAll(sheet(spark, "R1")).isEmpty() and made.count() == sheet(spark, "R1").count()


def test_empty_run(spark):
    assert sheet(spark, "R999").isEmpty()


def test_library_infix_goes_before_the_first_dot_only(spark):
    df = spark.createDataFrame(
        [("A", "yes"), ("A.B", "yes"), ("A.B.C.D", "yes"), ("A.B", "no"), ("A.B", None)],
        "lib string, flag string",
    )
    found = df.select(ids.single_stranded_library(F.col("lib"), F.col("flag"))).collect()
    assert [r[0] for r in found] == ["A", "A_ss.B", "A_ss.B.C.D", "A.B", "A.B"]


def test_prefix_is_rebased_at_the_start_only(spark):
    df = spark.createDataFrame([("/old/a",), ("/x/old/a",), ("/old",), (None,)], "p string")
    found = df.select(ids.rebase_path(F.col("p"), "/old", "/new")).collect()
    assert [r[0] for r in found] == ["/new/a", "/x/old/a", "/new", None]


def test_missing_parts_give_no_path(spark):
    df = spark.createDataFrame([("/d/", "s"), (None, "s"), ("/d/", None)], "d string, s string")
    found = df.select(ids.read_file_path(F.col("d"), F.col("s"))).collect()
    assert [r[0] for r in found] == ["/d/s.bam", None, None]


def test_flags_and_types(spark):
    df = spark.createDataFrame(
        [("Yes", "1", "2.5"), ("no", "x", ""), ("", None, None)], "f string, i string, d string"
    )
    schema = T.StructType([]).add("f", "boolean").add("i", "integer").add("d", "double")
    assert [tuple(r) for r in values.enforce_types(df, schema).collect()] == [
        (True, 1, 2.5),
        (False, None, None),
        (None, None, None),
    ]


def test_unchanged_sheets_are_found(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 2), ("c", 1), ("c", 1), ("e", 1)], "k string, v int")
    changed = run_sheets.changed_individuals(new, old, ["k"])
    assert {r.k for r in changed.collect()} == {"b", "c", "e"}


def test_readable_ids(spark):
    df = spark.createDataFrame([(1, 7, 8), (2, 9, None)], "id int, site int, lab int")
    names = spark.createDataFrame([(7, "seven"), (8, "eight")], "key int, name string")
    found = lims.resolve_ids(df, {"site": (names, "key", "name"), "lab": (names, "key", "name")})
    assert found.columns == ["id", "site", "lab"]
    assert {tuple(r) for r in found.collect()} == {(1, "seven", "eight"), (2, None, None)}


def test_lanes_are_counted_without_writing_rows_down_unless_a_sheet_is_large(spark, monkeypatch):
    tables = frames(spark)
    tables["analysis"] = tables["analysis"].unionByName(tables["analysis"])

    def made(**options):
        sheet = prepare.prepare_run_sheets(tables, runs(spark, "R1", "R4"), protocols(spark), **options)
        return Counter(tuple(row) for row in sheet.collect())

    sliced = made(limit=0)
    assert set(sliced.values()) == {1}

    def unwanted(*args, **options):
        raise AssertionError("rows were written down")

    monkeypatch.setattr(numbering, "written", unwanted)
    assert made() == sliced
    # The biggest sheet has more rows than that, so the rows are settled again.
    with pytest.raises(AssertionError, match="written down"):
        made(limit=1)


def test_foreign_pipelines_are_known_without_a_join(spark):
    flat = lims.lims_flat(frames(spark))
    typed = lims.with_analysis_type(flat).select(*flat.columns)
    assert Counter(map(tuple, lims.of_known_pipelines(flat).collect())) == Counter(map(tuple, typed.collect()))


def test_digest_of_a_sheet(spark):
    rows = [("TF", "A", "A1", "x", 2), ("TF", "A", "A1", None, 1), ("TF", "A", "A1", "x", 2), ("TF", None, "9", "", None)]
    sheet = spark.createDataFrame(rows, "analysis_type string, site_id string, target_ind string, a string, Lane long")

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    first = sorted(md5(text) for text in ('{"a":"x","Lane":"2"}', '{"a":null,"Lane":"1"}', '{"a":"x","Lane":"2"}'))
    expected = {("A1", md5(",".join(first))), ("9", md5(md5('{"a":"","Lane":null}')))}
    assert {(r.target_ind, r.digest) for r in run_sheets.sheet_digests(sheet).collect()} == expected
