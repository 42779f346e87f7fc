"""Write with each writer, read back with the matching reader, and compare with the plain select.

Everything goes to a fresh folder below the shared one that the session names.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.operators import housekeeping, packages
from cohortflow.queries import genotypes as geno_queries
from cohortflow.queries import lab, planning
from cohortflow.queries.lab_tables import text
from cohortflow.queries.registry import SQL, query, table
from cohortflow.session import scratch_path
from cohortflow.sinks import commits
from cohortflow.sinks import packages as package_sink
from cohortflow.sinks import tables as sink
from cohortflow.sources import files, tables


@query("rt_lims", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def rt_lims(spark, sf_dir):
    location = scratch_path(spark, "lims")
    table(spark, sf_dir, "orders").write.parquet(f"{location}/library.parquet")
    library = tables.read_lims(spark, location, ["library"])["library"]
    return library.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("rt_run_sheet", f"{lab.SHEET_SQL} SELECT * FROM sheet WHERE target_ind IS NOT NULL")
def rt_run_sheet(spark, sf_dir):
    path = scratch_path(spark, "sheets")
    sink.write_run_sheets(lab.sheet(spark, sf_dir), path, layout=sink.SITE_LAYOUT)
    return tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)


@query("rt_run_sheet_unnamed", f"{lab.SHEET_SQL} SELECT * FROM sheet WHERE target_ind IS NULL")
def rt_run_sheet_unnamed(spark, sf_dir):
    """Rows that the writer turns away."""
    path = scratch_path(spark, "sheets")
    return sink.write_run_sheets(lab.sheet(spark, sf_dir), path, layout=sink.SITE_LAYOUT)


_PEOPLE_SQL = """SELECT cast(c_custkey AS varchar) AS c_custkey, c_name,
                        CASE WHEN c_nationkey < 9 THEN c_mktsegment END AS c_mktsegment FROM customer"""


def _people(spark, sf_dir):
    segment = F.when(F.col("c_nationkey") < 9, F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        text("c_custkey").alias("c_custkey"), "c_name", segment.alias("c_mktsegment")
    )


@query("rt_debug", _PEOPLE_SQL)
def rt_debug(spark, sf_dir):
    path = scratch_path(spark, "debug")
    sink.write_debug(_people(spark, sf_dir), path)
    return (
        spark.read.schema("c_custkey string, c_name string, c_mktsegment string")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", V.SHEET_MISSING)
        .csv(path)
    )


@query("rt_metadata", _PEOPLE_SQL)
def rt_metadata(spark, sf_dir):
    path = scratch_path(spark, "metadata")
    people = _people(spark, sf_dir)
    sink.write_metadata(people, path)
    return tables.read_metadata(spark, path, people.columns)


def _index(spark, sf_dir):
    balance = F.col("c_acctbal")
    sex = F.when(balance < 0, "M").when(balance < 5000, "F").otherwise("U")
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("Population"),
        F.col("c_name").alias("Sample_Name"),
        F.lit("0").alias("father"),
        F.lit("0").alias("mother"),
        F.lit("1").alias("case_control"),
        sex.alias("Genetic_Sex"),
        F.col("c_custkey").alias("pos"),
    )


_SEX_SQL = "CASE WHEN c_acctbal < 0 THEN 'M' WHEN c_acctbal < 5000 THEN 'F' ELSE 'U' END"


@query(
    "rt_ind",
    f"""SELECT c_name AS "Sample_Name", {_SEX_SQL} AS "Genetic_Sex", c_mktsegment AS "Population"
        FROM customer""",
)
def rt_ind(spark, sf_dir):
    path = scratch_path(spark, "ind")
    sink.write_ind(_index(spark, sf_dir), path, "EIGENSTRAT")
    return tables.read_ind(spark, path, "EIGENSTRAT")


@query(
    "rt_ind_positions",
    f"""SELECT c_custkey AS pos, c_name AS "Sample_Name", {_SEX_SQL} AS "Genetic_Sex",
               c_mktsegment AS "Population" FROM customer""",
)
def rt_ind_positions(spark, sf_dir):
    """Written in key order over many part files; the position read back is the key."""
    path = scratch_path(spark, "ind")
    sink.write_ind(_index(spark, sf_dir), path, "EIGENSTRAT", order="pos")
    return files.read_positioned_ind(spark, path)


@query(
    "rt_fam",
    f"""SELECT c_mktsegment AS "Population", c_name AS "Sample_Name", '0' AS father, '0' AS mother,
               CASE {_SEX_SQL} WHEN 'M' THEN '1' WHEN 'F' THEN '2' ELSE '0' END AS sex_code,
               '1' AS case_control, {_SEX_SQL} AS "Genetic_Sex" FROM customer""",
)
def rt_fam(spark, sf_dir):
    path = scratch_path(spark, "fam")
    sink.write_ind(_index(spark, sf_dir), path, "PLINK")
    return tables.read_ind(spark, path, "PLINK")


@query("rt_id_list", "SELECT c_name AS id FROM customer")
def rt_id_list(spark, sf_dir):
    """IDs with blanks around them, and an empty line after some of them."""
    path = scratch_path(spark, "ids")
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    lines = F.when(F.col("c_nationkey") < 9, F.concat(padded, F.lit("\n "))).otherwise(padded)
    table(spark, sf_dir, "customer").select(lines.alias("value")).write.text(path)
    return tables.read_id_list(spark, path)


@query("rt_queue", SQL["queue"].replace("SELECT * FROM", "SELECT task_id, command FROM"))
def rt_queue(spark, sf_dir):
    """The queue as text: the line number read back is the task number."""
    path = scratch_path(spark, "queue")
    sink.write_queue(planning.pending_queue(spark, sf_dir), path)
    lines = files.numbered_lines(spark, path, "place")
    return lines.select((F.col("place") + 1).alias("task_id"), F.col("line").alias("command"))


@query("rt_snapshot", SQL["processed_counts"].replace("AS n_processed", "AS n_processed, 'S1' AS snapshot"))
def rt_snapshot(spark, sf_dir):
    root = scratch_path(spark, "stats")
    processed = housekeeping.processed_individuals(planning.report_files(spark, sf_dir))
    counts = planning.processed_counts(spark, sf_dir)
    sink.write_snapshot(processed, counts, root, F.lit("S1"))
    return spark.read.parquet(f"{root}/counts")


@query(
    "rt_snapshot_lists",
    f"""SELECT 'processed' AS list, * FROM ({SQL["processed"]})
        UNION ALL SELECT 'unique', NULL, individual FROM ({SQL["processed_unique"]})""",
)
def rt_snapshot_lists(spark, sf_dir):
    """The list of processed individuals and its unique form, read back from a dated snapshot."""
    root = scratch_path(spark, "stats")
    processed = housekeeping.processed_individuals(planning.report_files(spark, sf_dir))
    sink.write_snapshot(processed, planning.processed_counts(spark, sf_dir), root, F.lit("S1"))
    whole = spark.read.parquet(f"{root}/processed").where("snapshot = 'S1'")
    unique = spark.read.parquet(f"{root}/unique").where("snapshot = 'S1'")
    columns = [F.col(name) for name in ("list", "analysis_type", "individual")]
    whole = whole.withColumn("list", F.lit("processed")).select(*columns)
    unique = unique.withColumns({"list": F.lit("unique"), "analysis_type": F.lit(None).cast("string")})
    return whole.unionByName(unique.select(*columns))


def _written_package(spark, sf_dir):
    """A merged data set as text files."""
    path = scratch_path(spark, "package")
    lines, snps, inds = geno_queries.forged(spark, sf_dir)
    index = inds.select(
        "pos",
        F.col("sample_id").alias("Sample_Name"),
        F.col("sex").alias("Genetic_Sex"),
        F.col("group").alias("Population"),
    )
    package_sink.write_package(lines, snps, index, index.drop("pos"), path)
    return path


@query("rt_package", SQL["forge"])
def rt_package(spark, sf_dir):
    """Lines read back have the position they were written at."""
    return files.read_geno(spark, f"{_written_package(spark, sf_dir)}/geno")


@query(
    "rt_package_ind",
    """SELECT row_number() OVER (ORDER BY flag, n_nationkey) - 1 AS pos,
              'N' || lpad(cast(n_nationkey AS varchar), 2, '0') AS "Sample_Name", 'U' AS "Genetic_Sex",
              'Unknown' AS "Population"
       FROM nation, (VALUES ('A'), ('N'), ('R')) f(flag)""",
)
def rt_package_ind(spark, sf_dir):
    """The sample index of a written package, positions counted from the lines."""
    path = _written_package(spark, sf_dir)
    return files.read_positioned_ind(spark, f"{path}/ind").select("pos", "Sample_Name", "Genetic_Sex", "Population")


@query(
    "rt_package_metadata",
    """SELECT 'N' || lpad(cast(n_nationkey AS varchar), 2, '0') AS "Sample_Name", 'U' AS "Genetic_Sex",
              'Unknown' AS "Population"
       FROM nation, (VALUES ('A'), ('N'), ('R')) f(flag)""",
)
def rt_package_metadata(spark, sf_dir):
    path = _written_package(spark, sf_dir)
    return tables.read_metadata(spark, f"{path}/metadata", ["Sample_Name", "Genetic_Sex", "Population"])


@query(
    "rt_package_snps",
    SQL["forge_snps"].replace("p_size % 22 + 1 AS chrom", "cast(p_size % 22 + 1 AS varchar) AS chrom"),
)
def rt_package_snps(spark, sf_dir):
    path = scratch_path(spark, "package")
    _, snps, _ = geno_queries.forged(spark, sf_dir)
    package_sink.write_snps(snps, f"{path}/snp")
    return files.read_snp(spark, f"{path}/snp").select("snp_id", "chrom", "pos", "snp_idx")


@query(
    "publish",
    """WITH calls AS (
           SELECT DISTINCT l_returnflag AS package_id, l_partkey, s_nationkey
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
       widths AS (SELECT package_id, l_partkey, count(*) AS width FROM calls GROUP BY ALL),
       whole AS (
           SELECT w.package_id FROM widths w
           JOIN (SELECT package_id, count(DISTINCT s_nationkey) AS n FROM calls GROUP BY 1) USING (package_id)
           GROUP BY 1 HAVING bool_and(width = n))
       SELECT package_id, '1.0.0' AS version, 'Package creation' AS log_text FROM whole
       UNION
       SELECT DISTINCT 'filled_' || l_returnflag, '1.0.0', 'Package creation' FROM lineitem""",
)
def publish(spark, sf_dir):
    """Packages with gaps in their lines, and the same with gaps filled: only whole ones go live."""
    single = geno_queries.calls(spark, sf_dir).select("package_id", "snp_idx", "pos", "call")
    raw_lines = (
        single.groupBy("package_id", "snp_idx", "pos")
        .agg(F.min("call").alias("call"))
        .groupBy("package_id", "snp_idx")
        .agg(geno_queries.in_order().alias("line"))
    )
    filled = F.concat(F.lit("filled_"), F.col("package_id")).alias("package_id")
    whole = geno_queries.package_lines(spark, sf_dir)
    lines = raw_lines.unionByName(whole.select(filled, "snp_idx", "line"))
    snps = lines.select("package_id", F.col("snp_idx").alias("snp_id"))
    members = single.select("package_id", "pos").distinct()
    places = F.explode(F.sequence(F.lit(0), geno_queries.n_samples(spark, sf_dir) - 1))
    everyone = single.select("package_id").distinct().select(filled, places.alias("pos"))
    inds = members.unionByName(everyone)
    checks = packages.validate_package(lines, snps, inds.withColumnRenamed("pos", "sample_id"))
    catalog = scratch_path(spark, "catalog")
    package_sink.create_catalog(spark, catalog)
    staged = lines.select(
        "package_id", F.concat(F.lit("/staged/"), F.col("package_id")).alias("path")
    ).distinct()
    package_sink.publish_if_valid(staged, checks, catalog, log_text="Package creation")
    live = packages.latest_versions(package_sink.read_catalog(spark, catalog))
    return live.select("package_id", "version", "log_text")


@query(
    "publish_interleaved",
    """SELECT 'P' || c_custkey AS package_id, '1.0.0' AS version, 'first' AS log_text FROM customer
       UNION ALL SELECT 'P' || c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '2.0.0' ELSE '1.0.0' END, 'second'
       FROM customer WHERE c_custkey % 2 = 0
       UNION ALL SELECT 'P' || c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '2.1.0' ELSE '1.1.0' END, 'third'
       FROM customer WHERE c_custkey % 3 = 0""",
)
def publish_interleaved(spark, sf_dir):
    """Three publishers that all begin from the same commit: no version of a package is given twice."""
    catalog = scratch_path(spark, "catalog")
    package_sink.create_catalog(spark, catalog)
    everything = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("P"), text("c_custkey")).alias("package_id"), F.col("c_custkey").alias("key")
    )
    staged = everything.select("package_id", F.concat(F.lit("/staged/"), F.col("package_id")).alias("path"), "key")
    base = commits.latest(spark, catalog)
    good = everything.select("package_id", F.lit(True).alias("ok"))
    package_sink.publish_if_valid(staged.drop("key"), good, catalog, log_text="first", base=base)
    second = staged.where("key % 2 = 0").drop("key")
    package_sink.publish_if_valid(second, good, catalog, log_text="second", base=base)
    package_sink.merge_catalog(spark, catalog)
    package_sink.append_changelog(catalog, everything.where("key % 3 = 0"), "Minor", "third", base=base)
    return package_sink.read_catalog(spark, catalog).select("package_id", "version", "log_text")


_BLOCK = 1500
_TREE_SQL = f"""SELECT doc_id, source, encode(coalesce(text, '')) AS body,
        greatest(cast(ceil(octet_length(encode(coalesce(text, ''))) / {_BLOCK}.0) AS BIGINT), 1) AS n_blocks
    FROM documents"""
_FILE_SQL = f"""SELECT source AS package_id, 'doc' || doc_id || '.txt' AS name, octet_length(body) AS length, n_blocks,
        CASE n_blocks WHEN 1 THEN md5(body) ELSE md5(unhex(array_to_string(list_transform(range(0, n_blocks),
            lambda i: md5(body[{_BLOCK} * i + 1:{_BLOCK} * (i + 1)])), ''))) || '-' || n_blocks END AS md5
    FROM ({_TREE_SQL})"""


def _write_texts(batches, root):
    """Each document as a file in the folder of its source."""
    for batch in batches:
        for row in batch.to_pylist():
            folder = os.path.join(root, row["source"])
            os.makedirs(folder, exist_ok=True)
            with open(os.path.join(folder, f"doc{row['doc_id']}.txt"), "wb") as file:
                file.write((row["text"] or "").encode())
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])


def _published_texts(spark, sf_dir):
    """Documents as files of packages, one per source, published with their manifest; the path of the catalog."""
    root = scratch_path(spark, "texts").removeprefix("file:")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    docs.mapInArrow(lambda rows: _write_texts(rows, root), "n bigint").agg(F.sum("n")).collect()
    sources = docs.select(F.col("source").alias("package_id")).distinct()
    staged = sources.select("package_id", F.concat(F.lit(f"{root}/"), F.col("package_id")).alias("path"))
    catalog = scratch_path(spark, "catalog")
    package_sink.create_catalog(spark, catalog)
    package_sink.publish_if_valid(
        staged, sources.withColumn("ok", F.lit(True)), catalog, manifest=packages.manifest(staged, _BLOCK)
    )
    return catalog


@query("manifest_files", f"SELECT *, '1.0.0' AS version FROM ({_FILE_SQL})")
def manifest_files(spark, sf_dir):
    """Every file of every published package, hashed in blocks by several tasks."""
    return package_sink.read_manifest(spark, _published_texts(spark, sf_dir))


@query(
    "manifest_digests",
    f"""SELECT package_id, '1.0.0' AS version, md5(string_agg(md5 || ' ' || name, chr(10) ORDER BY name)) AS digest
        FROM ({_FILE_SQL}) GROUP BY 1""",
)
def manifest_digests(spark, sf_dir):
    """One digest per published package, kept in the catalog."""
    return package_sink.read_catalog(spark, _published_texts(spark, sf_dir)).select("package_id", "version", "digest")


@query("file_scan", "SELECT DISTINCT event_type AS folder FROM events")
def file_scan(spark, sf_dir):
    """Folders that hold non-empty files, found by listing what was written."""
    root = scratch_path(spark, "scan")
    events = table(spark, sf_dir, "events").select("event_type", text("event_id").alias("value"))
    events.write.partitionBy("event_type").text(root)
    found = files.scan_files(spark, root, "*.txt").filter("length > 0")
    folder = F.substring_index(F.split_part("path", F.lit("event_type="), F.lit(2)), "/", 1)
    return found.select(folder.alias("folder")).distinct()


def _place_files(batches, root):
    """For each row an own file of the given size and time; nothing depends on which task writes it."""
    for batch in batches:
        for row in batch.to_pylist():
            path = os.path.join(root, row["folder"], row["name"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "wb") as file:
                file.write(b"x" * row["length"])
            os.utime(path, (row["changed"], row["changed"]))
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])


_FILES_SQL = """SELECT 'site' || c_nationkey || CASE WHEN c_custkey % 3 = 0 THEN '/deep/er' ELSE '' END AS folder,
                       'ind' || c_custkey || CASE WHEN c_custkey % 7 = 0 THEN '.log' ELSE '.geno' END AS name,
                       c_custkey % 4 AS length, 1600000000 + c_custkey AS changed FROM customer"""


def _listed(spark, sf_dir, pattern, **options):
    """Files of many sites, a quarter of them empty, written down and listed."""
    root = scratch_path(spark, "states")
    customers = table(spark, sf_dir, "customer")
    deeper = F.when(F.col("c_custkey") % 3 == 0, "/deep/er").otherwise("")
    ending = F.when(F.col("c_custkey") % 7 == 0, ".log").otherwise(".geno")
    wanted = customers.select(
        F.concat(F.lit("site"), text("c_nationkey"), deeper).alias("folder"),
        F.concat(F.lit("ind"), text("c_custkey"), ending).alias("name"),
        (F.col("c_custkey") % 4).cast("long").alias("length"),
        (F.col("c_custkey") + 1600000000).cast("long").alias("changed"),
    )
    local = root.removeprefix("file:")
    wanted.repartition("folder").mapInArrow(lambda rows: _place_files(rows, local), "n bigint").agg(F.sum("n")).collect()
    found = files.scan_files(spark, root, pattern, **options)
    inner = F.split_part("path", F.lit(f"{root.rsplit('/', 1)[1]}/"), F.lit(2))
    return found.select(
        F.regexp_replace(inner, "/[^/]*$", "").alias("folder"),
        F.regexp_extract(inner, "[^/]*$", 0).alias("name"),
        "length",
        F.unix_timestamp("modificationTime").alias("changed"),
    )


@query("file_states", _FILES_SQL)
def file_states(spark, sf_dir):
    """Names, sizes and times of all files, empty ones too, as they were written."""
    return _listed(spark, sf_dir, "*")


@query(
    "file_states_recent",
    f"SELECT * FROM ({_FILES_SQL}) WHERE name LIKE '%.geno' AND changed > 1600000100",
)
def file_states_recent(spark, sf_dir):
    """Of one kind of name, and changed after a moment."""
    return _listed(spark, sf_dir, "*.geno", modified_after="2020-09-13T12:28:20")
