"""Quality results, metadata and sample indexes."""

import pytest
from pyspark.sql import functions as F

from cohortflow.functions import ids, values
from cohortflow.operators import metadata, qc

SHEET = "Sample_Name string, Library_ID string, Strandedness string, UDG_Treatment string"


def test_summary_per_sample_and_strandedness(spark):
    rows = [
        ("A", "l1", "double", "half"),
        ("A", "l2", "double", "half"),
        ("A_ss", "l3", "single", "none"),
        ("B", "l1", "double", "half"),
        ("B", "l2", "double", "none"),
        ("C", "l1", "Unknown", None),
        ("C", "l2", "Unknown", "half"),
        ("D", "l1", "double", None),
        ("D", "l2", "double", None),
    ]
    found = qc.sample_summary(spark.createDataFrame(rows, SHEET)).collect()
    assert {tuple(r) for r in found} == {
        ("A", "double", "half", 2, "1240K;1240K", "ds"),
        ("A_ss", "single", "none", 1, "1240K", "ss"),
        ("B", "double", "mixed", 2, "1240K;1240K", "ds"),
        ("C", "Unknown", "mixed", 2, "1240K;1240K", None),
        ("D", "double", None, 2, "1240K;1240K", "ds"),
    }


def compiled(spark, sheets, **tables):
    sexdet = tables.get("sexdet") or [("A", 0.4, 0.01, 0.5, 0.02)]
    snpcov = tables.get("snpcov") or [("A", 5000)]
    nuccont = tables.get("nuccont") or [("l1", 0.1, 0.01, 99), ("l2", 0.2, 0.02, 100), ("l3", 0.5, 0.04, 300)]
    return qc.compile_qc(
        spark.createDataFrame(sheets, SHEET),
        spark.createDataFrame(
            sexdet, "Sample_Name string, x_rate double, x_err double, y_rate double, y_err double"
        ),
        spark.createDataFrame(snpcov, "Sample_Name string, covered_snps bigint"),
        spark.createDataFrame(
            nuccont,
            "Library_ID string, contamination double, contamination_err double, contamination_snps bigint",
        ),
        tables.get("damage"),
        tables.get("endogenous"),
    )


LIBRARIES = [
    ("A", "l1", "double", "half"),
    ("A", "l1", "double", "half"),
    ("A", "l2", "double", "half"),
    ("A", "l3", "double", "half"),
    ("B", "l9", "double", "half"),
]


def test_results_join_left_and_absent_tables_give_null(spark):
    rows = {(r.Sample_Name, r.Library_ID): r for r in compiled(spark, LIBRARIES).collect()}
    assert len(rows) == 4
    assert rows["A", "l1"].Genetic_Sex == "M" and rows["A", "l1"].covered_snps == 5000
    assert rows["A", "l1"].damage is None and rows["A", "l1"].endogenous is None
    assert rows["B", "l9"].Genetic_Sex is None and rows["B", "l9"].contamination is None


def test_across_libraries(spark):
    damage = spark.createDataFrame(
        [("l1", 0.5, 10), ("l2", 0.25, 30)], "Library_ID string, damage double, damage_reads bigint"
    )
    endogenous = spark.createDataFrame(
        [("l1", 3.0), ("l2", 7.0)], "Library_ID string, endogenous double"
    )
    libraries = compiled(spark, LIBRARIES, damage=damage, endogenous=endogenous)
    rows = {r.Sample_Name: r for r in qc.compile_across_libs(libraries).collect()}
    a, b = rows["A"], rows["B"]
    # The estimate on 99 SNPs is left out, the one on 100 counts.
    assert a.Contamination == pytest.approx((0.2 * 100 + 0.5 * 300) / 400)
    assert a.Contamination_Err == pytest.approx((0.02 * 100 + 0.04 * 300) / 400)
    assert a.Contamination_Note.startswith("Nr Snps (per library): 99;100;300.")
    assert a.Contamination_Meas == "ANGSD"
    assert a.Damage == pytest.approx((0.5 * 10 + 0.25 * 30) / 40)
    assert (a.Endogenous, a.Nr_SNPs, a.Nr_Libraries) == (7.0, 5000, 3)
    assert (a.Library_Names, a.Capture_Type) == (["l1", "l2", "l3"], "1240K;1240K;1240K")
    assert a.Sex_Determination_Note == "x-rate: 0.400 +- 0.010, y-rate: 0.500 +- 0.020"
    assert (b.Contamination, b.Contamination_Note) == (None, "No results found.")
    assert b.Sex_Determination_Note is None


@pytest.mark.parametrize("cutoff, expected", [(99, 99), (100, 100), (101, 300), (301, None)])
def test_snp_cutoff_is_inclusive(spark, cutoff, expected):
    """The smallest library that still counts is the one on exactly the cutoff."""
    libraries = compiled(spark, LIBRARIES)
    used = libraries.filter(
        qc.usable(F.col("contamination"), F.col("contamination_snps"), cutoff).isNotNull()
    )
    assert used.agg(F.min("contamination_snps")).first()[0] == expected


@pytest.mark.parametrize(
    "x, y, sex",
    [(0.7, 0.0, "F"), (1.2, 0.1, "F"), (0.2, 0.3, "M"), (0.6, 0.6, "M"), (0.65, 0.2, "U"), (1.3, 0.0, "U")],
)
def test_sex_ranges_are_closed(spark, x, y, sex):
    found = spark.range(1).select(values.classify_sex(F.lit(x), F.lit(y))).first()[0]
    assert found == sex


def test_overwrite_join(spark):
    left = spark.createDataFrame(
        [("a", "1", "x"), ("b", "2", "y"), ("c", "3", "z")], "id string, v string, w string"
    )
    right = spark.createDataFrame([("a", "9", "n"), ("b", None, "m")], "name string, v string, u string")
    found = metadata.overwrite_join(left, right, "id", "name")
    assert found.columns == ["id", "w", "v", "u"]
    assert {tuple(r) for r in found.collect()} == {
        ("a", "x", "9", "n"),
        ("b", "y", None, "m"),
        ("c", "z", None, None),
    }
    kept = metadata.overwrite_join(left, right, "id", "name", keep_left_when_null=True)
    assert {(r.id, r.v) for r in kept.collect()} == {("a", "9"), ("b", "2"), ("c", "3")}


def test_lab_columns_reach_single_stranded_samples(spark):
    existing = spark.createDataFrame(
        [("A", "U", "keep"), ("A_ss", "U", "keep"), ("B", "U", "keep")],
        "sample string, Genetic_Sex string, note string",
    )
    results = spark.createDataFrame([("A", "F"), ("A_ss", "M"), ("A", "F")], "Sample_Name string, Genetic_Sex string")
    lab = spark.createDataFrame([("A", "here"), ("Z", "there")], "individual string, place string")
    found = metadata.update_metadata(existing, results, lab, "sample")
    assert {tuple(r) for r in found.select("sample", "note", "Genetic_Sex", "place").collect()} == {
        ("A", "keep", "F", "here"),
        ("A_ss", "keep", "M", "here"),
        ("B", "keep", None, None),
    }


def test_attach_keeps_both_sides(spark):
    samples = spark.createDataFrame([("a", "s1"), ("b", "s2")], "individual string, sample string")
    lab = spark.createDataFrame([("a", "p"), ("c", "q")], "individual string, place string")
    found = metadata.attach_lims(samples, lab)
    assert {tuple(r) for r in found.collect()} == {("s1", "p"), ("s2", None), (None, "q")}


def test_index_follows_metadata(spark):
    index = spark.createDataFrame(
        [("a", "U", "Unknown"), ("b", "U", "Unknown")],
        "Sample_Name string, Genetic_Sex string, Population string",
    )
    meta = spark.createDataFrame([("a", "F", "G1;G2")], "id string, Genetic_Sex string, Group_Name string")
    found = metadata.sync_index(index, meta, "id")
    assert {tuple(r) for r in found.collect()} == {("a", "F", "G1"), ("b", None, None)}


def test_double_stranded_samples_come_first(spark):
    double = spark.createDataFrame([(0, "d0"), (1, "d1")], "pos long, sample string")
    single = spark.createDataFrame([(0, "s0"), (1, "s1")], "pos long, sample string")
    found = metadata.concat_indexes(double, single).orderBy("pos").collect()
    assert [tuple(r) for r in found] == [(0, "d0"), (1, "d1"), (2, "s0"), (3, "s1")]


def test_library_names(spark):
    df = spark.createDataFrame([(["A_ss.1", "A.1", "B_ssx_ss.2"],)], "names array<string>")
    both = df.select(
        ids.clean_library_names(F.col("names")), ids.clean_library_names(F.col("names"), anchored=True)
    ).first()
    assert both[0] == ["A.1", "Bx.2"]
    assert both[1] == ["A.1", "B_ssx.2"]


def test_groups_from_ids(spark):
    df = spark.createDataFrame([("ABC001",), ("ABC001_ss",), ("AB",), ("_ss",)], "id string")
    assert [r[0] for r in df.select(ids.group_from_id(F.col("id"))).collect()] == ["ABC", "ABC", "", ""]


def test_text_form(spark):
    df = spark.createDataFrame([(1, None, ["a", "b"], 0.5)], "i int, s string, l array<string>, d double")
    assert tuple(values.textify(df).first()) == ("1", "n/a", "a;b", "0.5")
    filled = values.fill_ploidy(spark.createDataFrame([(None,), ("diploid",)], "Genotype_Ploidy string"))
    assert [r[0] for r in filled.collect()] == ["haploid", "diploid"]


def test_sex_codes_round_trip(spark):
    df = spark.createDataFrame([("1",), ("2",), ("0",), ("9",), (None,)], "code string")
    decoded = df.select(values.decode_sex(F.col("code")).alias("sex"))
    assert [r[0] for r in decoded.collect()] == ["M", "F", "U", "U", "U"]
    encoded = decoded.select(values.encode_sex(F.col("sex"))).collect()
    assert [r[0] for r in encoded] == ["1", "2", "0", "0", "0"]


def test_results_of_listed_files_only(spark):
    sheets = spark.createDataFrame([("A", "l1"), ("A", "l1")], "Sample_Name string, Library_ID string")
    named = qc.merged_read_names(sheets)
    results = spark.createDataFrame([("A.trimmed.bam", 1), ("B.trimmed.bam", 2)], "file string, v int")
    assert [tuple(r) for r in qc.restrict_qc(results, named).collect()] == [("A.trimmed.bam", 1)]
