"""Quality reports and run sheets written more than once, read back through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.plans import prepare
from cohortflow.queries import lab
from cohortflow.queries.lab_tables import text
from cohortflow.queries.registry import query, table
from cohortflow.session import scratch_path, written
from cohortflow.sinks import tables as sink
from cohortflow.sources import results, tables

# Kind of report: its fields in Spark and in SQL, over customers. Customers of even segments lack the last field.
_REPORTS = {
    "sexdet": (
        {"x_rate": "c_custkey % 13 / 10D", "x_err": "0.25D", "y_rate": "c_custkey % 7 / 10D", "y_err": "0.5D"},
        {"x_rate": "(c_custkey % 13)::double / 10", "x_err": "0.25::double", "y_rate": "(c_custkey % 7)::double / 10", "y_err": "0.5::double"},
    ),
    "snpcov": (
        {"covered_snps": "c_custkey * 10", "total_snps": "c_custkey * 20"},
        {"covered_snps": "c_custkey * 10", "total_snps": "c_custkey * 20"},
    ),
    "nuccont": (
        {"contamination": "c_custkey % 9 / 8D", "contamination_err": "0.125D", "contamination_snps": "c_custkey % 300"},
        {"contamination": "(c_custkey % 9)::double / 8", "contamination_err": "0.125::double", "contamination_snps": "c_custkey % 300"},
    ),
    "damage": (
        {"damage": "c_custkey % 5 / 4D", "damage_reads": "c_custkey * 3"},
        {"damage": "(c_custkey % 5)::double / 4", "damage_reads": "c_custkey * 3"},
    ),
    "endogenous": ({"endogenous": "c_custkey % 64 / 64D"}, {"endogenous": "(c_custkey % 64)::double / 64"}),
}
_PER_REPORT = 500


def _write_reports(spark, sf_dir, kind):
    """One file for each range of customers, one object in it, keyed by customer."""
    fields, _ = _REPORTS[kind]
    *_, last = fields
    columns = [F.expr(value).alias(name) for name, value in fields.items()]
    shorter = F.when(F.col("c_nationkey") % 2 == 1, F.expr(fields[last])).alias(last)
    entry = F.struct(*columns[:-1], shorter)
    reports = (
        table(spark, sf_dir, "customer")
        .select(
            F.floor(F.col("c_custkey") / _PER_REPORT).alias("part"),
            F.struct(F.concat(F.lit("C"), text("c_custkey")).alias("key"), entry.alias("value")).alias("entry"),
        )
        .groupBy("part")
        .agg(F.to_json(F.map_from_entries(F.collect_list("entry"))).alias("value"))
    )
    path = scratch_path(spark, f"reports-{kind}")
    reports.write.partitionBy("part").text(path)
    return path


def _report_query(kind):
    _, sql = _REPORTS[kind]
    *others, last = sql
    key, _ = results.QC_SCHEMAS[kind]
    listed = ", ".join(f"{sql[name]} AS {name}" for name in others)
    short = f"CASE WHEN c_nationkey % 2 = 1 THEN {sql[last]} END AS {last}"

    @query(
        f"rt_qc_{kind}",
        f"""SELECT 'C' || c_custkey AS "{key}", {listed + ', ' if listed else ''}{short} FROM customer""",
    )
    def read_back(spark, sf_dir):
        path = _write_reports(spark, sf_dir, kind)
        found = results.read_qc_json(spark, path, kind, pattern="*.txt")
        absent = results.read_qc_json(spark, f"{path}-absent", kind, optional=True)
        return found.unionByName(absent)

    return read_back


for _kind in _REPORTS:
    _report_query(_kind)


# Some individuals have IDs that do not start with a letter, so their site is empty.
_NUMBERED_SQL = f"""{lab.SHEET_SQL}, numbered AS (
    SELECT * EXCLUDE (target_ind, site_id),
           CASE WHEN target_ind LIKE '%3' THEN '9' || target_ind ELSE target_ind END AS target_ind,
           CASE WHEN target_ind LIKE '%3' THEN '' ELSE site_id END AS site_id
    FROM sheet WHERE target_ind IS NOT NULL)"""
_UPDATED_SQL = f"""{_NUMBERED_SQL}
    SELECT * EXCLUDE ("Organism"),
           CASE WHEN target_ind LIKE '%1' OR target_ind LIKE '9%7' OR target_ind LIKE '9%23'
                THEN 'new ' || "Organism" ELSE "Organism" END AS "Organism" FROM numbered"""


def _numbered_sheet(spark, sf_dir):
    sheet = lab.sheet(spark, sf_dir)
    odd = F.col("target_ind").endswith("3")
    return written(
        sheet.withColumn("site_id", F.when(odd, F.lit("")).otherwise(F.col("site_id"))).withColumn(
            "target_ind", F.when(odd, F.concat(F.lit("9"), "target_ind")).otherwise(F.col("target_ind"))
        )
    )


_CHANGES = "target_ind LIKE '%1' OR target_ind LIKE '9%7' OR target_ind LIKE '9%23'"


def _changed(sheet):
    return sheet.filter(_CHANGES).withColumn("Organism", F.concat(F.lit("new "), "Organism"))


def _again(sheet):
    """All sheets, those of ``_changed`` as they are there."""
    new = F.when(F.expr(_CHANGES), F.concat(F.lit("new "), "Organism")).otherwise(F.col("Organism"))
    return sheet.withColumn("Organism", new)


@query("rt_run_sheet_update", _UPDATED_SQL)
def rt_run_sheet_update(spark, sf_dir):
    """All sheets written, some of them written again, all read back."""
    path = scratch_path(spark, "sheets")
    sheet = _numbered_sheet(spark, sf_dir)
    sink.write_run_sheets(sheet, path, layout=sink.SITE_LAYOUT)
    sink.write_run_sheets(_changed(sheet), path, layout=sink.SITE_LAYOUT)
    return tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)


@query("rt_run_sheet_only_changed", _UPDATED_SQL)
def rt_run_sheet_only_changed(spark, sf_dir):
    """The same, where the second write gets all sheets and must find those that differ."""
    path = scratch_path(spark, "sheets")
    sheet = _numbered_sheet(spark, sf_dir)
    sink.write_run_sheets(sheet, path, layout=sink.SITE_LAYOUT)
    previous = tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)
    sink.write_run_sheets(_again(sheet), path, previous, only_changed=True, layout=sink.SITE_LAYOUT)
    return tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)


@query("rt_run_sheet_digests", _UPDATED_SQL)
def rt_run_sheet_digests(spark, sf_dir):
    """The same by the stored digests of the sheets: what was written before is not read to be compared."""
    path, digests = scratch_path(spark, "sheets"), scratch_path(spark, "digests")
    sheet = _numbered_sheet(spark, sf_dir)
    sink.write_run_sheets(sheet, path, layout=sink.SITE_LAYOUT, digests=digests)
    for _ in range(2):
        sink.write_run_sheets(_again(sheet), path, only_changed=True, layout=sink.SITE_LAYOUT, digests=digests)
        sink.merge_digests(spark, digests)
    return tables.read_run_sheets(spark, path, sink.SITE_LAYOUT)


@query(
    "rt_sheet_queue",
    f"""{_NUMBERED_SQL}
        SELECT row_number() OVER (ORDER BY analysis_type, site_id, target_ind) AS task_id, analysis_type, site_id,
               target_ind AS individual
        FROM (SELECT DISTINCT analysis_type, site_id, target_ind FROM numbered)
        WHERE target_ind LIKE '%1' OR target_ind LIKE '9%7' OR target_ind LIKE '9%23'""",
)
def rt_sheet_queue(spark, sf_dir):
    """Sheets side by side in the files of a site; reports lie between the first write and the second."""
    path = scratch_path(spark, "sheets")
    sheet = _numbered_sheet(spark, sf_dir)
    sink.write_run_sheets(sheet, path, layout=sink.SITE_LAYOUT)
    first = prepare.written_at(sheet, path, F.lit("2024-01-01").cast("timestamp"))
    second = prepare.written_at(_changed(sheet), path, F.lit("2024-03-01").cast("timestamp"))
    inputs = prepare.sheet_individuals(
        tables.read_run_sheets(spark, path, sink.SITE_LAYOUT), first.unionByName(second)
    )
    reports = first.select(
        "analysis_type",
        "site_id",
        F.col("target_ind").alias("individual"),
        F.lit("2024-02-01").cast("timestamp").alias("modificationTime"),
    )
    settings = {"runner": "run", "version": "1", "profiles": "p", "config": "c", "extra": ""}
    queue = prepare.plan_queue(inputs, reports, "/out", settings)
    return queue.select("task_id", "analysis_type", "site_id", "individual")


@query(
    "rt_versions",
    f"""{_NUMBERED_SQL}
        SELECT DISTINCT analysis_type, site_id, target_ind,
               CASE WHEN target_ind LIKE '%1' OR target_ind LIKE '9%7' OR target_ind LIKE '9%23'
                    THEN '2' ELSE '1' END AS producer_version FROM numbered""",
)
def rt_versions(spark, sf_dir):
    """Sheets published by one version, some of them by the next, and an empty set that is not written."""
    path, versions = scratch_path(spark, "sheets"), scratch_path(spark, "versions")
    sheet = _numbered_sheet(spark, sf_dir)
    prepare.publish_run_sheets(sheet, path, versions, version="1")
    prepare.publish_run_sheets(_changed(sheet), path, versions, version="2")
    prepare.publish_run_sheets(sheet.limit(0), path, versions, version="3")
    return sink.latest_versions(spark, versions)
