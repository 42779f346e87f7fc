"""Readers and writers on real files."""

import hashlib
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC

import pytest
from pyspark.sql import functions as F

from cohortflow.operators import packages
from cohortflow.plans import prepare
from cohortflow.session import broadcast_if_small, scratch_path, shared_dir, written
from cohortflow.sinks import commits
from cohortflow.sinks import packages as package_sink
from cohortflow.sinks import tables as sink
from cohortflow.sources import files, listing, results, tables

COLUMNS = (
    "analysis_type string, site_id string, target_ind string, Sample_Name string, Library_ID string, "
    "Lane long, Colour_Chemistry int, SeqType string, Organism string, Strandedness string, "
    "UDG_Treatment string, R1 string, R2 string, BAM string"
)


def sheet(spark, *individuals, organism="human"):
    rows = [
        ("TF", i[:3] if i else None, i, i, f"{i}.A{lane}", lane, 4, "SE", organism, "double", "half", None, None, "/b")
        for i in individuals
        for lane in (2, 1)
    ]
    return spark.createDataFrame(rows, COLUMNS)


def state(path):
    """Folder of each individual and the modification time of its files."""
    found = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".csv"):
                found.setdefault(os.path.basename(folder), []).append(
                    os.stat(os.path.join(folder, name)).st_mtime_ns
                )
    return found


def test_only_touched_individuals_are_replaced(spark, tmp_path):
    path = str(tmp_path / "sheets")
    unnamed = sink.write_run_sheets(sheet(spark, "ABC001", "ABC002", None), path)
    assert unnamed.count() == 2
    before = state(path)
    assert set(before) == {"target_ind=ABC001", "target_ind=ABC002"}
    time.sleep(0.05)
    sink.write_run_sheets(sheet(spark, "ABC002", "DEF001", organism="other"), path)
    after = state(path)
    assert after["target_ind=ABC001"] == before["target_ind=ABC001"]
    assert after["target_ind=ABC002"] != before["target_ind=ABC002"]
    back = tables.read_run_sheets(spark, path)
    assert {(r.target_ind, r.Organism) for r in back.collect()} == {
        ("ABC001", "human"), ("ABC002", "other"), ("DEF001", "other"),
    }
    assert back.filter("R1 is null and BAM = '/b'").count() == 6


def test_lanes_are_in_order_in_the_file(spark, tmp_path):
    path = str(tmp_path / "sheets")
    sink.write_run_sheets(sheet(spark, "ABC001"), path)
    (name,) = [
        os.path.join(folder, n) for folder, _, names in os.walk(path) for n in names if n.endswith(".csv")
    ]
    lines = open(name).read().splitlines()
    assert lines[0].split("\t")[:3] == ["Sample_Name", "Library_ID", "Lane"]
    assert [line.split("\t")[2] for line in lines[1:]] == ["1", "2"]
    assert lines[1].split("\t")[8:10] == ["NA", "NA"]


def test_unchanged_sheets_stay_old(spark, tmp_path):
    path = str(tmp_path / "sheets")
    sink.write_run_sheets(sheet(spark, "ABC001", "ABC002"), path)
    before = state(path)
    previous = tables.read_run_sheets(spark, path)
    new = sheet(spark, "ABC001").unionByName(sheet(spark, "ABC002", organism="other"))
    time.sleep(0.05)
    sink.write_run_sheets(new, path, previous=previous, only_changed=True)
    after = state(path)
    assert after["target_ind=ABC001"] == before["target_ind=ABC001"]
    assert after["target_ind=ABC002"] != before["target_ind=ABC002"]
    with pytest.raises(ValueError):
        sink.write_run_sheets(new, path, only_changed=True)


def test_site_layout_carries_the_others_over(spark, tmp_path):
    path = str(tmp_path / "sheets")
    sink.write_run_sheets(sheet(spark, "ABC001", "ABC002", "DEF001"), path, layout=sink.SITE_LAYOUT)
    before = state(path)
    previous = tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)
    sink.write_run_sheets(
        sheet(spark, "ABC002", organism="other"), path, previous=previous, layout=sink.SITE_LAYOUT
    )
    back = tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)
    assert {(r.target_ind, r.Organism) for r in back.collect()} == {
        ("ABC001", "human"), ("ABC002", "other"), ("DEF001", "human"),
    }
    assert state(path)["site_id=DEF"] == before["site_id=DEF"]


def test_versions_next_to_sheets(spark, tmp_path):
    sink.write_versions(sheet(spark, "ABC001"), str(tmp_path / "v"), "9.9")
    assert {(r.target_ind, r.producer_version) for r in spark.read.parquet(str(tmp_path / "v")).collect()} == {
        ("ABC001", "9.9")
    }


def test_empty_guard(spark, capsys):
    assert sink.report_empty(sheet(spark, "ABC001").limit(0), "nothing yet")
    assert "nothing yet" in capsys.readouterr().out
    assert not sink.report_empty(sheet(spark, "ABC001"), "nothing yet")


@pytest.mark.parametrize("fmt", ["EIGENSTRAT", "PLINK"])
def test_index_formats(spark, tmp_path, fmt):
    index = spark.createDataFrame(
        [("s1", "M", "P", "0", "0", "1"), ("s2", "F", "P", "0", "0", "1"), ("s3", "U", "P", "0", "0", "1")],
        "Sample_Name string, Genetic_Sex string, Population string, father string, mother string, case_control string",
    )
    path = str(tmp_path / "ind")
    sink.write_ind(index, path, fmt)
    back = tables.read_ind(spark, path, fmt)
    assert {(r.Sample_Name, r.Genetic_Sex, r.Population) for r in back.collect()} == {
        ("s1", "M", "P"), ("s2", "F", "P"), ("s3", "U", "P"),
    }
    if fmt == "PLINK":
        assert {(r.Sample_Name, r.sex_code) for r in back.collect()} == {("s1", "1"), ("s2", "2"), ("s3", "0")}


def test_unknown_format_is_refused(spark):
    with pytest.raises(ValueError, match="EIGENSTRAT or PLINK"):
        tables.read_ind(spark, "/nowhere", "VCF")


def test_id_list(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("ABC001\n\n  ABC002 \n")
    assert [r.id for r in tables.read_id_list(spark, str(tmp_path / "ids.txt")).collect()] == ["ABC001", "ABC002"]


def test_reports(spark, tmp_path):
    for i in (1, 2):
        folder = tmp_path / f"ABC00{i}"
        folder.mkdir()
        (folder / "x_coverage.json").write_text(
            json.dumps({f"s{i}": {"covered_snps": i, "total_snps": 10}, f"t{i}": {"covered_snps": 5}}, indent=1)
        )
        (folder / "other.txt").write_text("{}")
    found = results.read_qc_json(spark, str(tmp_path), "snpcov", pattern="*_coverage.json")
    assert {tuple(r) for r in found.collect()} == {("s1", 1, 10), ("t1", 5, None), ("s2", 2, 10), ("t2", 5, None)}


def test_absent_reports_are_empty(spark, tmp_path):
    found = results.read_qc_json(spark, str(tmp_path / "none"), "damage", optional=True)
    assert found.columns == ["Library_ID", "damage", "damage_reads"] and found.isEmpty()


def test_line_positions_over_file_blocks(spark, tmp_path):
    """Long lines cross the borders of small blocks; positions still follow the file."""
    lines = [f"{i}:" + "x" * (i % 97) for i in range(5000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        numbered = files.numbered_lines(spark, str(tmp_path / "big.txt"), "n")
        assert spark.read.text(str(tmp_path / "big.txt")).rdd.getNumPartitions() > 10
        assert {r.n: r.line for r in numbered.collect()} == dict(enumerate(lines))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_positions_over_parts_and_per_file(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"part-0000{part}.txt").write_text(f"{part}a\n{part}b\n")
    whole = files.numbered_lines(spark, str(tmp_path), "n").orderBy("n").collect()
    assert [(r.n, r.line) for r in whole] == list(enumerate(["0a", "0b", "1a", "1b", "2a", "2b"]))
    single = files.numbered_lines(spark, str(tmp_path), "n", per_file=True)
    assert {(r.n, r.line[1]) for r in single.collect()} == {(0, "a"), (1, "b")}


def test_genotype_files(spark, tmp_path):
    (tmp_path / "x.geno").write_text("012\n999\n")
    (tmp_path / "x.snp").write_text("  rs1 1 0.5 100 A G\nrs2\t2\t0.0\t200\tC\tT\n")
    (tmp_path / "x.ind").write_text("a\tM\tP\nb\tF\tP\n")
    assert {tuple(r) for r in files.read_geno(spark, str(tmp_path / "x.geno")).collect()} == {(0, "012"), (1, "999")}
    snps = files.read_snp(spark, str(tmp_path / "x.snp")).orderBy("snp_idx").collect()
    assert [tuple(r) for r in snps] == [
        (0, "rs1", "1", 0.5, 100, "A", "G"), (1, "rs2", "2", 0.0, 200, "C", "T"),
    ]
    inds = files.read_positioned_ind(spark, str(tmp_path / "x.ind")).orderBy("pos").collect()
    assert [tuple(r) for r in inds] == [(0, "a", "M", "P"), (1, "b", "F", "P")]


def test_file_states_and_checksums(spark, tmp_path):
    (tmp_path / "TF" / "ABC").mkdir(parents=True)
    (tmp_path / "TF" / "ABC" / "one.geno").write_bytes(b"hello")
    (tmp_path / "TF" / "ABC" / "one.txt").write_bytes(b"t")
    (tmp_path / "TF" / "ABC" / "empty.txt").write_bytes(b"")
    (tmp_path / ".hidden").mkdir()
    (tmp_path / ".hidden" / "two.geno").write_bytes(b"x")
    found = files.scan_files(spark, str(tmp_path), "*.geno")
    assert found.columns == ["path", "modificationTime", "length"]
    assert [(os.path.basename(r.path), r.length) for r in found.collect()] == [("one.geno", 5)]
    os.utime(tmp_path / "TF" / "ABC" / "one.geno", (0, 1_600_000_000))
    recent = files.scan_files(spark, str(tmp_path), modified_after="2021-01-01T00:00:00")
    # Empty files count: existence is what plans ask for.
    assert sorted((os.path.basename(r.path), r.length) for r in recent.collect()) == [("empty.txt", 0), ("one.txt", 1)]
    sums = packages.checksums(files.scan_files(spark, str(tmp_path), "*.geno", content=True))
    assert sums.first().md5 == "5d41402abc4b2a76b9719d911017c592"


def test_unchanged_sheets_are_known_by_their_digest(spark, tmp_path, monkeypatch):
    path, digests = str(tmp_path / "sheets"), str(tmp_path / "digests")

    def unread(*args):
        raise AssertionError("old sheets were read")

    monkeypatch.setattr(sink, "read_run_sheets", unread)
    first = sheet(spark, "ABC001", "ABC002")
    sink.write_run_sheets(first, path, digests=digests)
    before = {f: os.stat(f).st_mtime_ns for f in (str(p) for p in (tmp_path / "sheets").rglob("*.csv"))}
    # Rows in another order are the same sheet.
    sink.write_run_sheets(first.orderBy("Lane").repartition(1), path, only_changed=True, digests=digests)
    assert {f: os.stat(f).st_mtime_ns for f in before} == before
    mixed = sheet(spark, "ABC001").unionByName(sheet(spark, "ABC002", "ABC003", organism="dog"))
    sink.write_run_sheets(mixed, path, only_changed=True, digests=digests)
    after = {str(p) for p in (tmp_path / "sheets").rglob("*.csv")}
    assert [f for f in before if "ABC001" in f] == [f for f in after if "ABC001" in f]
    assert not {f for f in before if "ABC002" in f} & after and any("ABC003" in f for f in after)
    assert sink.read_digests(spark, digests).count() == 3
    sink.merge_digests(spark, digests)
    sink.write_run_sheets(mixed, path, only_changed=True, digests=digests)
    assert {str(p) for p in (tmp_path / "sheets").rglob("*.csv")} == after


def test_few_changed_sheets_are_found_without_a_shuffle_of_the_others(spark, tmp_path, monkeypatch):
    path, digests = str(tmp_path / "sheets"), str(tmp_path / "digests")
    sink.write_run_sheets(sheet(spark, "ABC001", "ABC002", "DEF001"), path, layout=sink.SITE_LAYOUT, digests=digests)
    sent = []

    def counted(lookup):
        sent.append({tuple(row) for row in lookup.collect()})
        return broadcast_if_small(lookup)

    monkeypatch.setattr(sink, "broadcast_if_small", counted)
    again = sheet(spark, "ABC001", "DEF001").unionByName(sheet(spark, "ABC002", organism="dog"))
    sink.write_run_sheets(again, path, only_changed=True, layout=sink.SITE_LAYOUT, digests=digests)
    assert sent == [{("TF", "ABC", "ABC002")}, {("TF", "ABC")}, {("TF", "ABC", "ABC002")}]
    back = tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)
    assert sorted((r.target_ind, r.Lane, r.Organism) for r in back.collect()) == [
        (i, lane, "dog" if i == "ABC002" else "human") for i in ("ABC001", "ABC002", "DEF001") for lane in (1, 2)
    ]


def test_listing_sees_every_file(spark, tmp_path):
    expected = {}
    for k in range(60):
        folder = tmp_path / f"s{k % 7}" / ("a/b/c" if k % 3 else "")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{k}.txt").write_bytes(b"y" * (k % 3))
        os.utime(folder / f"f{k}.txt", (0, 1_500_000_000 + k))
        expected[f"file:{folder / f'f{k}.txt'}"] = (k % 3, 1_500_000_000 + k)
    (tmp_path / "top.txt").write_bytes(b"")
    os.utime(tmp_path / "top.txt", (0, 1_500_000_000))
    expected[f"file:{tmp_path / 'top.txt'}"] = (0, 1_500_000_000)
    (tmp_path / "s1" / "_hidden").mkdir()
    (tmp_path / "s1" / "_hidden" / "x.txt").write_bytes(b"z")
    (tmp_path / "empty folder").mkdir()
    # However far the planner opens folders itself, and however the root is spelled.
    for folders in (1, 2, 9, 500):
        for root in (str(tmp_path), f"file://{tmp_path}/", f"file:{tmp_path}"):
            found = listing.list_files(spark, root, folders=folders).collect()
            assert len(found) == len(expected)
            assert {r.path: (r.length, int(r.modificationTime.replace(tzinfo=UTC).timestamp())) for r in found} == expected
    assert listing.list_files(spark, str(tmp_path / "empty folder")).count() == 0
    assert listing.list_files(spark, str(tmp_path / "nowhere")).count() == 0


def test_listing_is_shared_out(tmp_path):
    for k in range(40):
        (tmp_path / f"s{k}" / "inner").mkdir(parents=True)
    files, path, _ = listing.file_system(str(tmp_path))
    few = listing.shares(files, path, 8)
    assert sorted(few)[0] == (str(tmp_path), False) and sum(below for _, below in few) == 40
    many = listing.shares(files, path, 10_000)
    # Nothing is left to open.
    assert len(many) == 81 and not any(below for _, below in many)
    reader = listing.FileListingReader({"path": str(tmp_path), "folders": "8"})
    dealt = [folder for part in reader.partitions() for folder in part.folders]
    assert len(reader.partitions()) == 8 and sorted(dealt) == sorted(few)
    assert not listing.reachable("viewfs://store/x")


def test_sheet_files_and_queue(spark, tmp_path):
    root = str(tmp_path / "in")
    sink.write_run_sheets(sheet(spark, "ABC001", "DEF001"), root)
    sheets = prepare.sheet_files(files.scan_files(spark, root, "*.csv"), f"file:{root}")
    assert {(r.analysis_type, r.site_id, r.individual) for r in sheets.collect()} == {
        ("TF", "ABC", "ABC001"), ("TF", "DEF", "DEF001"),
    }
    newest = sheets.agg(F.max("modificationTime")).first()[0]
    reports = spark.createDataFrame(
        [("TF", "ABC", "ABC001", newest)],
        "analysis_type string, site_id string, individual string, modificationTime timestamp",
    )
    settings = {"runner": "run", "version": "1", "profiles": "p", "config": "c", "extra": ""}
    queue = prepare.plan_queue(sheets, reports, "/out", settings)
    (row,) = queue.collect()
    assert (row.task_id, row.individual) == (1, "DEF001")
    assert "--outdir /out/TF/DEF/DEF001 -w /out/TF/DEF/DEF001/temp" in row.command
    assert row.command.startswith(f"cd file:{root}/analysis_type=TF/site_id=DEF/target_ind=DEF001 ; run -r 1")
    sensitive = spark.createDataFrame([("DEF001.A1",)], "id string")
    assert prepare.plan_queue(sheets, reports, "/out", settings, sensitive).isEmpty()


def test_publishing_keeps_the_old_version_on_failure(spark, tmp_path):
    catalog = str(tmp_path / "catalog")
    package_sink.create_catalog(spark, catalog)

    def live():
        latest = packages.latest_versions(package_sink.read_catalog(spark, catalog))
        return {r.package_id: (r.version, r.path) for r in latest.collect()}

    def publish(path, *verdicts):
        staged = spark.createDataFrame([(p, f"{path}/{p}") for p, _ in verdicts], "package_id string, path string")
        checks = spark.createDataFrame(
            [(p, ok) for p, ok in verdicts] + [(p, True) for p, _ in verdicts], "package_id string, ok boolean"
        )
        package_sink.publish_if_valid(staged, checks, catalog)

    publish("/v1", ("a", True), ("b", False))
    assert live() == {"a": ("1.0.0", "/v1/a")}
    publish("/v2", ("a", False), ("b", True))
    assert live() == {"a": ("1.0.0", "/v1/a"), "b": ("1.0.0", "/v2/b")}
    publish("/v3", ("a", True))
    assert live()["a"] == ("2.0.0", "/v3/a")
    ids = spark.createDataFrame([("a",)], "package_id string")
    package_sink.append_changelog(catalog, ids, "Minor", "Added checksums")
    assert live()["a"] == ("2.1.0", "/v3/a")
    logs = package_sink.read_catalog(spark, catalog).filter("package_id = 'a'").orderBy("version")
    assert [r.log_text for r in logs.collect()] == ["Update genotypes", "Update genotypes", "Added checksums"]


def test_publishers_at_the_same_time_get_different_versions(spark, tmp_path):
    catalog = str(tmp_path / "catalog")
    package_sink.create_catalog(spark, catalog)
    with pytest.raises(FileExistsError):
        package_sink.create_catalog(spark, catalog)
    staged = spark.createDataFrame([("a", "/s/a")], "package_id string, path string")
    checks = spark.createDataFrame([("a", True)], "package_id string, ok boolean")

    def publish(k):
        return package_sink.publish_if_valid(staged, checks, catalog, log_text=f"by {k}", base=0)

    with ThreadPoolExecutor(5) as pool:
        numbers = list(pool.map(publish, range(5)))
    assert sorted(numbers) == [1, 2, 3, 4, 5]
    rows = package_sink.read_catalog(spark, catalog).collect()
    assert sorted(r.version for r in rows) == [f"{k}.0.0" for k in range(1, 6)]
    assert {r.log_text for r in rows} == {f"by {k}" for k in range(5)}
    assert package_sink.read_catalog(spark, catalog, 2).count() == 2
    # Merging changes no row, and later commits follow it.
    assert package_sink.merge_catalog(spark, catalog) == 6
    assert sorted(r.version for r in package_sink.read_catalog(spark, catalog).collect()) == sorted(r.version for r in rows)
    assert len(commits._live(spark, catalog, None)) == 1
    assert publish(9) == 7 and package_sink.read_catalog(spark, catalog).count() == 6


def test_a_file_is_created_by_one_writer_only(spark, tmp_path):
    path = str(tmp_path / "deep" / "x.json")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: commits.create_if_absent(spark, path, str(k)), range(8)))
    assert made.count(True) == 1
    assert open(path, encoding="utf-8").read() == str(made.index(True))
    assert os.listdir(tmp_path / "deep") == ["x.json"]


def test_manifests_are_stored_with_versions(spark, tmp_path):
    for name, data in (("one/geno", b"x" * 25), ("one/inner/snp", b""), ("two/geno", b"hello")):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    catalog = str(tmp_path / "catalog")
    package_sink.create_catalog(spark, catalog)
    staged = spark.createDataFrame([(p, str(tmp_path / p)) for p in ("one", "two")], "package_id string, path string")
    checks = spark.createDataFrame([("one", True), ("two", True)], "package_id string, ok boolean")
    first = packages.manifest(staged, block=10)
    package_sink.publish_if_valid(staged, checks, catalog, manifest=first)

    def md5(data):
        return hashlib.md5(data)

    parts = b"".join(md5(b"x" * n).digest() for n in (10, 10, 5))
    files_ = {(r.package_id, r.name): (r.version, r.length, r.n_blocks, r.md5) for r in package_sink.read_manifest(spark, catalog).collect()}
    assert files_ == {
        ("one", "geno"): ("1.0.0", 25, 3, f"{md5(parts).hexdigest()}-3"),
        ("one", "inner/snp"): ("1.0.0", 0, 1, md5(b"").hexdigest()),
        ("two", "geno"): ("1.0.0", 5, 1, md5(b"hello").hexdigest()),
    }
    digests = {r.package_id: r.digest for r in package_sink.read_catalog(spark, catalog).collect()}
    assert digests["two"] == md5(f"{md5(b'hello').hexdigest()} geno".encode()).hexdigest()
    (tmp_path / "two" / "geno").write_bytes(b"hullo")
    (tmp_path / "two" / "new").write_bytes(b"1")
    (tmp_path / "one" / "inner" / "snp").unlink()
    changes = packages.changed_files(first, packages.manifest(staged, block=10)).collect()
    assert {tuple(r) for r in changes} == {("two", "geno", "changed"), ("two", "new", "added"), ("one", "inner/snp", "removed")}


def test_scratch_paths_come_from_the_session(spark):
    folder = shared_dir(spark)
    own = f"{folder.rstrip('/')}/cohortflow-{spark.sparkContext.applicationId}"
    assert scratch_path(spark, "x").startswith(f"{own}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert written(spark.range(3)).count() == 3


def test_broadcast_only_of_counted_tables(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()

    assert hinted(broadcast_if_small(spark.range(10), rows=10))
    assert not hinted(broadcast_if_small(spark.range(11), rows=10))
