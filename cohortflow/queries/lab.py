"""Lab tables to run sheets."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow.functions import ids, values
from cohortflow.operators import cohorts, lims, run_sheets
from cohortflow.plans import prepare
from cohortflow.queries import lab_tables as lab
from cohortflow.queries.registry import query, table
from cohortflow.session import fixed_table


@query("lims_flat", f"WITH {lab.FLAT_SQL} SELECT * FROM flat")
def lims_flat(spark, sf_dir):
    return lab.flat(spark, sf_dir)


@query(
    "lims_flat_type",
    f"WITH {lab.FLAT_SQL} SELECT * FROM flat WHERE analysis_id IN ('HUMAN_TM', 'Human_TM')",
)
def lims_flat_type(spark, sf_dir):
    return lims.lims_flat(lab.lab_tables(spark, sf_dir), "TM")


@query(
    "resolve_ids",
    """SELECT c_custkey, c_name, n_name AS c_nationkey
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2""",
)
def resolve_ids(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").filter("n_regionkey <> 2")
    return lims.resolve_ids(people, {"c_nationkey": (nations, "n_nationkey", "n_name")})


@query(
    "enforce_types",
    """SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS flag,
              try_cast(substr(o_orderpriority, 1, 1 + o_orderkey % 2) AS integer) AS level
       FROM orders""",
)
def enforce_types(spark, sf_dir):
    status = F.col("o_orderstatus")
    cut = F.substr("o_orderpriority", F.lit(1), (1 + F.col("o_orderkey") % 2).cast("int"))
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", "Yes").when(status == "O", "no").otherwise("?").alias("flag"),
        cut.alias("level"),
    )
    wanted = T.StructType().add("flag", T.BooleanType()).add("level", T.IntegerType())
    return values.enforce_types(raw, wanted)


@query(
    "consent_3vl",
    f"""WITH people AS ({lab.CUSTOMERS_SQL})
        SELECT id, ethically_culturally_sensitive,
               CASE WHEN id % 5 = 0 THEN NULL ELSE id % 13 = 0 END AS exclude
        FROM people
        WHERE ethically_culturally_sensitive = false
          AND (id % 5 = 0 OR id % 13 <> 0)""",
)
def consent_3vl(spark, sf_dir):
    key = F.col("id")
    people = lab.customers(spark, sf_dir).select(
        "id",
        "ethically_culturally_sensitive",
        F.when(key % 5 == 0, None).otherwise(key % 13 == 0).alias("exclude"),
    )
    return lims.not_excluded(lims.consented(people))


@query(
    "cohort_ids",
    f"""WITH {lab.FLAT_SQL}
        SELECT full_individual_id, run_id FROM flat
        UNION
        SELECT main_individual_id, run_id FROM flat WHERE main_individual_id <> ''""",
)
def cohort_ids(spark, sf_dir):
    return cohorts.cohort_ids(lab.flat(spark, sf_dir), ["run_id"])


def _first_run(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.agg(F.min(F.date_format("o_orderdate", "yyyyMM")).alias("run_id"))


def _expanded(spark, sf_dir, by):
    """Rows of all individuals that the first run touches."""
    run = _first_run(spark, sf_dir)
    flat = cohorts.flat_of_runs(lab.lab_tables(spark, sf_dir), run, by)
    return cohorts.expand_cohort(flat, run.scalar(), by)


_EXPANDED_SQL = f"""WITH {lab.FLAT_SQL},
    one AS (SELECT min(strftime(o_orderdate, '%Y%m')) AS run_id FROM orders),
    hit AS (SELECT * FROM flat WHERE run_id = (SELECT run_id FROM one))"""


@query(
    "expand_cohort",
    f"""{_EXPANDED_SQL}
        SELECT * FROM flat WHERE full_individual_id IN (
            SELECT full_individual_id FROM hit
            UNION SELECT main_individual_id FROM hit WHERE main_individual_id <> '')""",
)
def expand_cohort(spark, sf_dir):
    return _expanded(spark, sf_dir, "full")


_TARGET_SQL = """coalesce(CASE WHEN main_individual_id = '' THEN full_individual_id
                               ELSE main_individual_id END, full_individual_id)"""


@query(
    "expand_cohort_canonical",
    f"""{_EXPANDED_SQL}
        SELECT * FROM flat WHERE {_TARGET_SQL} IN (SELECT {_TARGET_SQL} FROM hit)""",
)
def expand_cohort_canonical(spark, sf_dir):
    return _expanded(spark, sf_dir, "canonical")


@query(
    "expand_cohorts_last_run",
    f"""WITH {lab.KEPT_SQL}, {lab.RUNS_SQL},
        hit AS (SELECT * FROM kept WHERE run_id IN (SELECT run_id FROM runs)),
        touched AS (
            SELECT analysis_type, run_id, full_individual_id FROM hit
            UNION
            SELECT analysis_type, run_id, main_individual_id FROM hit
            WHERE main_individual_id <> ''),
        keyed AS (SELECT *, CASE WHEN main_individual_id = '' THEN full_individual_id
                                 ELSE main_individual_id END AS target FROM kept),
        last AS (
            SELECT k.analysis_type, k.target, max(t.run_id) AS run_id
            FROM (SELECT DISTINCT analysis_type, target, full_individual_id FROM keyed
                  WHERE result_directory IS NOT NULL) k
            JOIN touched t USING (analysis_type, full_individual_id) GROUP BY ALL)
        SELECT k.* EXCLUDE (target) FROM keyed k
        JOIN last l USING (analysis_type, target)
        JOIN touched t ON t.analysis_type = k.analysis_type AND t.run_id = l.run_id
                      AND t.full_individual_id = k.full_individual_id""",
)
def expand_cohorts_last_run(spark, sf_dir):
    runs = lab.latest_year(spark, sf_dir)
    return prepare.cohort_rows(lab.lab_tables(spark, sf_dir), runs, policy="last_run")


@query(
    "library_specs",
    """WITH specs(p_type, strandedness, udg) AS (VALUES
           ('ECONOMY', 'double', 'half'), ('LARGE', 'double', 'none'), ('MEDIUM', 'single', 'Unknown'),
           ('PROMO', 'single', 'half'), ('SMALL', 'double', 'Unknown'))
       SELECT l_orderkey, l_partkey, p_type,
              coalesce(strandedness, 'Unknown') AS "Strandedness",
              CASE WHEN strandedness = 'single' AND udg = 'Unknown' THEN 'none'
                   ELSE coalesce(udg, 'Unknown') END AS "UDG_Treatment"
       FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN specs USING (p_type)""",
)
def library_specs(spark, sf_dir):
    rows = [
        ("ECONOMY", "double", "half"),
        ("LARGE", "double", "none"),
        ("MEDIUM", "single", "Unknown"),
        ("PROMO", "single", "half"),
        ("SMALL", "double", "Unknown"),
    ]
    specs = fixed_table(spark, rows, "protocol string, strandedness string, udg string")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).drop("p_partkey")
    return lims.infer_library_specs(joined, specs, "p_type")


_SHEET_SQL = f"""{lab.KEPT_SQL}, {lab.RUNS_SQL}, {lab.PROTOCOLS_SQL},
hit AS (SELECT * FROM kept WHERE run_id IN (SELECT run_id FROM runs)),
cohort AS (
    SELECT analysis_type, full_individual_id FROM hit
    UNION
    SELECT analysis_type, main_individual_id FROM hit WHERE main_individual_id <> ''),
picked AS (
    SELECT DISTINCT analysis_type,
           CASE WHEN main_individual_id = '' THEN full_individual_id
                ELSE main_individual_id END AS target_ind,
           full_individual_id, main_individual_id, organism, full_library_id, kept.protocol,
           result_directory, sequencing_id, full_sequencing_id, single_stranded
    FROM kept JOIN cohort USING (analysis_type, full_individual_id)
    WHERE result_directory IS NOT NULL),
sheet AS (
    SELECT analysis_type,
           regexp_extract(target_ind, '^([A-Za-z]+)', 1) AS site_id,
           target_ind,
           CASE WHEN single_stranded = 'yes' THEN target_ind || '_ss' ELSE target_ind END
               AS "Sample_Name",
           CASE WHEN single_stranded = 'yes' THEN regexp_replace(full_library_id, '\\.', '_ss.')
                ELSE full_library_id END AS "Library_ID",
           row_number() OVER (
               PARTITION BY analysis_type, target_ind
               ORDER BY full_individual_id, full_library_id, sequencing_id, full_sequencing_id,
                        result_directory, picked.protocol, organism, single_stranded,
                        main_individual_id) AS "Lane",
           4 AS "Colour_Chemistry", 'SE' AS "SeqType", organism AS "Organism",
           coalesce(strandedness, 'Unknown') AS "Strandedness",
           CASE WHEN strandedness = 'single' AND udg = 'Unknown' THEN 'none'
                ELSE coalesce(udg, 'Unknown') END AS "UDG_Treatment",
           CAST(NULL AS varchar) AS "R1", CAST(NULL AS varchar) AS "R2",
           regexp_replace(result_directory, '^{lab.OLD_ROOT}/', '{lab.NEW_ROOT}/')
               || full_sequencing_id || '.bam' AS "BAM"
    FROM picked LEFT JOIN protocols ON picked.protocol = protocols.protocol)"""


def sheet(spark, sf_dir, **options):
    """Run sheets of all individuals touched by a run of the last year, all types at once."""
    return prepare.prepare_run_sheets(
        lab.lab_tables(spark, sf_dir),
        lab.latest_year(spark, sf_dir),
        lab.protocols(spark),
        rebase=(f"{lab.OLD_ROOT}/", f"{lab.NEW_ROOT}/"),
        **options,
    )


SHEET_SQL = f"WITH {_SHEET_SQL}"


@query("run_sheet", f"{SHEET_SQL} SELECT * FROM sheet")
def run_sheet(spark, sf_dir):
    return sheet(spark, sf_dir)


@query("run_sheet_sliced", f"{SHEET_SQL} SELECT * FROM sheet")
def run_sheet_sliced(spark, sf_dir):
    """The same sheets, numbered the way that individuals too big for one task are."""
    return sheet(spark, sf_dir, limit=0)


@query(
    "prepare_report",
    f"""{SHEET_SQL}
        SELECT analysis_type, count(DISTINCT target_ind) + max(CASE WHEN target_ind IS NULL
               THEN 1 ELSE 0 END) AS n_individuals FROM sheet GROUP BY 1""",
)
def prepare_report(spark, sf_dir):
    return run_sheets.prepare_report(sheet(spark, sf_dir))


@query(
    "strandedness_conflicts",
    f"""{SHEET_SQL}
        SELECT * FROM sheet WHERE suffix("Sample_Name", '_ss') <> ("Strandedness" = 'single')""",
)
def strandedness_conflicts(spark, sf_dir):
    return run_sheets.strandedness_conflicts(sheet(spark, sf_dir))


@query(
    "rename_dots",
    f"""SELECT o_orderkey, replace({lab.LIBRARY_SQL}, '.', '_') AS "Library_ID" FROM orders""",
)
def rename_dots(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return run_sheets.rename_dots(orders.select("o_orderkey", lab.library_id().alias("Library_ID")))


@query(
    "whitelist",
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def whitelist(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return run_sheets.whitelisted(
        people, listed.select(F.col("o_custkey").alias("id")), on="c_custkey"
    )


@query(
    "changed_sheets",
    """SELECT DISTINCT o_custkey AS target_ind FROM orders
       WHERE o_orderstatus = 'P' OR o_totalprice > 400000""",
)
def changed_sheets(spark, sf_dir):
    """Sheets of customers' orders: some rows get a new status, some are new."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("target_ind"), "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    old = rows.filter("o_totalprice <= 400000").withColumn(
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "P", "X").otherwise(F.col("o_orderstatus")),
    )
    return run_sheets.changed_individuals(rows, old, ["target_ind"])


@query(
    "invalid_types",
    """SELECT l_orderkey, code FROM (
           SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'TF' WHEN 'N' THEN 'XX' END AS code
           FROM lineitem)
       WHERE code IS NULL OR code NOT IN ('TF', 'TM', 'SG', 'RP', 'RM', 'YC', 'IM', 'BL')""",
)
def invalid_types(spark, sf_dir):
    flag = F.col("l_returnflag")
    code = F.when(flag == "A", "TF").when(flag == "N", "XX")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", code.alias("code"))
    return lims.invalid_types(lines, "code")


@query(
    "id_parts",
    f"""SELECT o_orderkey,
               regexp_extract(lib, '^([A-Za-z]+)', 1) AS site_id,
               split_part(lib, '.', 1) AS from_sequencing,
               regexp_replace(split_part(lib, '.', 1), '_ss$', '') AS individual,
               CASE WHEN o_orderstatus = 'F' THEN split_part(lib, '.', 1) || '_ss'
                    ELSE split_part(lib, '.', 1) END AS sample
        FROM (SELECT o_orderkey, o_orderstatus,
                     CASE WHEN o_orderstatus = 'F'
                          THEN regexp_replace({lab.LIBRARY_SQL}, '\\.', '_ss.')
                          ELSE {lab.LIBRARY_SQL} END AS lib FROM orders)""",
)
def id_parts(spark, sf_dir):
    flag = F.when(F.col("o_orderstatus") == "F", "yes")
    orders = table(spark, sf_dir, "orders")
    lib = F.col("lib")
    first = ids.before_first_dot(lib)
    return orders.withColumn("lib", ids.single_stranded_library(lab.library_id(), flag)).select(
        "o_orderkey",
        ids.site_id(lib).alias("site_id"),
        first.alias("from_sequencing"),
        ids.individual_id(lib).alias("individual"),
        ids.single_stranded_name(first, flag).alias("sample"),
    )


@query(
    "path_parts",
    """SELECT page_id, str_split(url, '/')[3] AS host, str_split(url, '/')[-1] AS last,
              CASE WHEN suffix(str_split(url, '/')[-1], '#top')
                   THEN left(str_split(url, '/')[-1], -4) ELSE str_split(url, '/')[-1] END AS base,
              str_split(url, '/')[9] AS beyond
       FROM pages""",
)
def path_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        ids.path_part(url, 3).alias("host"),
        ids.path_part(url, -1).alias("last"),
        ids.base_name(url, "#top").alias("base"),
        ids.path_part(url, 9).alias("beyond"),
    )
