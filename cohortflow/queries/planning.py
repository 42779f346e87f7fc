"""Events seen as file states: what is new, stale, restricted, processed, or to be cleared."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.operators import housekeeping, packages, parameters, planning, restriction
from cohortflow.plans import changes
from cohortflow.queries.lab_tables import text
from cohortflow.queries.registry import query, table
from cohortflow.session import fixed_table, scratch_path

ROOT = "/results"
FOLDERS = {
    "click": "Human_1240k",
    "view": "Human_Shotgun",
    "purchase": "Human_RP",
    "error": "Blanks",
    "signup": "Human_Y",
}
TYPE_OF_EVENT = {"click": "TF", "view": "SG", "purchase": "RP", "error": "BL", "signup": "YC"}


def case(column: str, mapping: dict[str, str]):
    chosen = None
    for key, value in mapping.items():
        condition = F.col(column) == key
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return chosen


def case_sql(column: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in mapping.items())
    return f"CASE {column} {arms} END"


def event_files(spark, sf_dir):
    """Each event as a read file below its type's folder and its user's run."""
    name = F.concat(
        text("event_id"), F.when(F.col("value") < 5, ".bam.bai").otherwise(".bam")
    )
    path = F.concat_ws("/", F.lit(ROOT), case("event_type", FOLDERS), text("user_id"), name)
    return table(spark, sf_dir, "events").select(
        path.alias("path"), F.col("ts").alias("modificationTime")
    )


_NOW_SQL = "(SELECT max(ts) FROM events)"


@query(
    "new_runs",
    f"""SELECT DISTINCT t.code AS analysis_type, cast(user_id AS varchar) AS run_id
        FROM events JOIN (VALUES ('click', 'TF'), ('click', 'TM'), ('view', 'SG'),
             ('purchase', 'RP'), ('error', 'BL'), ('signup', 'YC')) t(kind, code) ON event_type = kind
        WHERE value >= 5 AND cast(user_id AS varchar) LIKE '2%'
          AND ts >= {_NOW_SQL} - INTERVAL 24 HOUR""",
)
def new_runs(spark, sf_dir):
    files = event_files(spark, sf_dir)
    now = files.agg(F.max("modificationTime")).scalar()
    return planning.new_runs(files, now, ROOT)


def _states(spark, sf_dir, event_type):
    """Newest event of one type per user and day, as the state of that individual's file."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == event_type)
    individual = F.concat(text("user_id"), F.date_format("ts", "'D'dd"))
    return events.groupBy(individual.alias("individual")).agg(
        F.max("ts").alias("modificationTime")
    )


_DAY = "cast(user_id AS varchar) || strftime(ts, 'D%d')"
_PENDING_SQL = f"""
    inputs AS (SELECT {_DAY} AS individual, max(ts) AS t FROM events
               WHERE event_type = 'click' GROUP BY 1),
    reports AS (SELECT {_DAY} AS individual, max(ts) AS t FROM events
                WHERE event_type = 'purchase' GROUP BY 1),
    pending AS (SELECT individual FROM inputs i LEFT JOIN reports r USING (individual)
                WHERE r.t IS NULL OR i.t > r.t)"""


def _pending(spark, sf_dir):
    inputs = _states(spark, sf_dir, "click")
    return planning.pending_runs(inputs, _states(spark, sf_dir, "purchase"), ["individual"])


@query("pending_runs", f"WITH {_PENDING_SQL} SELECT individual FROM pending")
def pending_runs(spark, sf_dir):
    return _pending(spark, sf_dir).select("individual")


def _day_files(spark, sf_dir):
    """Events as files of an individual: clicks are inputs, purchases are reports."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "purchase"))
    return events.select(
        F.concat(text("user_id"), F.date_format("ts", "'D'dd")).alias("individual"),
        F.concat_ws("/", F.lit(ROOT), "event_type", text("event_id")).alias("path"),
        F.col("ts").cast("timestamp").alias("modificationTime"),
        F.lit(1).cast("long").alias("length"),
        F.col("event_type").alias("kind"),
    )


def _due(files):
    inputs, reports = files.filter("kind = 'click'"), files.filter("kind = 'purchase'")
    newest = inputs.groupBy("individual").agg(F.max("modificationTime").alias("modificationTime"))
    return planning.pending_runs(newest, reports, ["individual"]).select("individual")


@query("pending_changes", f"WITH {_PENDING_SQL} SELECT individual FROM pending")
def pending_changes(spark, sf_dir):
    """Pending individuals kept up to date over four passes: some files, others, all of them, and the same once more."""
    files, store = _day_files(spark, sf_dir), scratch_path(spark, "pending")
    third = F.pmod(F.xxhash64("path"), F.lit(3))
    passes = (files.filter(third != 0), files.filter(third != 1), files, files)
    for listing in passes:
        found = changes.refresh(spark, store, listing, ["individual"], _due, "individual string")
    return found


@query(
    "file_changes",
    f"""WITH files AS (SELECT {_DAY} AS individual, '{ROOT}/' || event_type || '/' || event_id AS path, event_id, value
                   FROM events WHERE event_type IN ('click', 'purchase')),
        old AS (SELECT individual, path, 1 AS length FROM files WHERE event_id % 4 <> 0),
        new AS (SELECT individual, path, CASE WHEN value < 5 THEN 2 ELSE 1 END AS length FROM files WHERE event_id % 4 <> 1)
        SELECT individual, path, CASE WHEN old.length IS NULL THEN 'added' WHEN new.length IS NULL THEN 'removed'
                                      ELSE 'changed' END AS change
        FROM old FULL JOIN new USING (individual, path) WHERE old.length IS DISTINCT FROM new.length""",
)
def file_changes(spark, sf_dir):
    """Files that came, went or got another size between two listings."""
    files = _day_files(spark, sf_dir)
    number = F.element_at(F.split("path", "/"), -1).cast("long")
    values = table(spark, sf_dir, "events").select(F.col("event_id").alias("number"), "value")
    sized = files.withColumn("number", number).join(values, "number")
    grown = sized.withColumn("length", F.when(F.col("value") < 5, 2).otherwise(1).cast("long"))
    return changes.file_changes(files.filter(number % 4 != 0), grown.filter("number % 4 <> 1"), ["individual"])


SETTINGS = {
    "runner": "run",
    "version": "2.5.0",
    "profiles": "base,local_paths",
    "config": "/conf/site.config",
    "extra": "",
}

_QUEUE_SQL = f"""{_PENDING_SQL},
    queue AS (
        SELECT individual, row_number() OVER (ORDER BY individual) AS task_id,
               'cd /in/' || individual || ' ; run -r 2.5.0 -profile base,local_paths,TF'
               || ' -c /conf/site.config --input /in/' || individual || '/' || individual || '.tsv'
               || ' --outdir /out/' || individual || ' -w /out/' || individual
               || '/temp -ansi-log false -resume' AS command
        FROM pending)"""


def pending_queue(spark, sf_dir, limit=planning.GROUP_LIMIT):
    individual = F.col("individual")
    directory = F.concat(F.lit("/in/"), individual)
    pending = _pending(spark, sf_dir).select(
        "individual",
        F.lit("TF").alias("analysis_type"),
        directory.alias("directory"),
        F.concat(directory, F.lit("/"), individual, F.lit(".tsv")).alias("path"),
        F.concat(F.lit("/out/"), individual).alias("outdir"),
    )
    commands = planning.queue_command(pending, SETTINGS).select("individual", "command")
    return planning.with_task_id(commands, ["individual"], limit)


@query("queue", f"WITH {_QUEUE_SQL} SELECT * FROM queue")
def queue(spark, sf_dir):
    return pending_queue(spark, sf_dir)


@query("queue_sliced", f"WITH {_QUEUE_SQL} SELECT * FROM queue")
def queue_sliced(spark, sf_dir):
    """The same queue, numbered the way that one too long for one task is."""
    return pending_queue(spark, sf_dir, limit=0)


@query("queue_task", f"WITH {_QUEUE_SQL} SELECT * FROM queue WHERE task_id = 17")
def queue_task(spark, sf_dir):
    return planning.task(pending_queue(spark, sf_dir), 17)


@query("queue_size", f"WITH {_QUEUE_SQL} SELECT count(*) AS n_tasks FROM queue")
def queue_size(spark, sf_dir):
    return planning.queue_size(pending_queue(spark, sf_dir))


@query(
    "package_plan",
    f"""WITH keyed AS (SELECT {_DAY} AS individual, event_type, ts FROM events),
        states AS (
            SELECT individual,
                   bool_or(event_type IN ('click', 'view', 'signup')) AS has_results,
                   max(ts) FILTER (event_type = 'click') AS single,
                   max(ts) FILTER (event_type = 'view') AS double,
                   max(ts) FILTER (event_type = 'purchase') AS package,
                   bool_or(event_type = 'purchase') AS has_package
            FROM keyed GROUP BY 1)
        SELECT individual,
               CASE WHEN NOT has_results THEN 'ERROR_NO_DIR'
                    WHEN single IS NULL AND double IS NULL THEN 'ERROR_NO_GENO'
                    WHEN NOT has_package AND single IS NOT NULL AND double IS NOT NULL
                        THEN 'CREATE_MIXED'
                    WHEN NOT has_package THEN 'CREATE_SINGLE'
                    WHEN coalesce(single > package, false) OR coalesce(double > package, false)
                        THEN CASE WHEN single IS NOT NULL AND double IS NOT NULL
                                  THEN 'UPDATE_MIXED' ELSE 'UPDATE_SINGLE' END
                    ELSE 'NO_CHANGE' END AS state
        FROM states""",
)
def package_plan(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.concat(text("user_id"), F.date_format("ts", "'D'dd")).alias("individual"),
        "event_type",
        F.col("ts").alias("modificationTime"),
    )
    names = {"click": V.SINGLE_GENOTYPES, "view": V.DOUBLE_GENOTYPES, "signup": "report.html"}
    files = events.withColumn("name", case("event_type", names)).filter("name IS NOT NULL")
    wanted = events.select("individual").distinct()
    plan = planning.plan_packages(wanted, files, _states(spark, sf_dir, "purchase"))
    return plan.select("individual", "state")


def _restricted(spark, sf_dir):
    """Orders of unknown status stand for sensitive sequencings of their customers."""
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P' AND o_totalprice > 400000")
    return orders.select(
        F.concat(F.lit("C"), text("o_custkey"), F.lit(".A1."), text("o_orderkey")).alias("id")
    )


_RESTRICTED_SQL = """restricted AS (
    SELECT DISTINCT 'C' || o_custkey AS individual FROM orders
    WHERE o_orderstatus = 'P' AND o_totalprice > 400000)"""


@query(
    "scrub",
    f"""WITH {_RESTRICTED_SQL}
        SELECT o_orderkey, sample FROM (
            SELECT o_orderkey, 'C' || o_custkey || CASE WHEN o_orderstatus = 'F' THEN '_ss' ELSE '' END
                   AS sample, 'C' || o_custkey AS individual FROM orders)
        WHERE individual NOT IN (SELECT individual FROM restricted)""",
)
def scrub(spark, sf_dir):
    suffix = F.when(F.col("o_orderstatus") == "F", "_ss").otherwise("")
    samples = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("C"), text("o_custkey"), suffix).alias("sample")
    )
    return restriction.scrub(samples, _restricted(spark, sf_dir), "sample")


_STATUS_TYPES = {"F": "TF", "O": "SG", "P": "XX"}


@query(
    "scrub_audit",
    f"""WITH {_RESTRICTED_SQL}
        SELECT DISTINCT 'C' || o_custkey AS individual,
               {case_sql("o_orderstatus", _STATUS_TYPES)} AS analysis_type,
               CASE WHEN o_totalprice > 250000 THEN 'output' ELSE 'input' END AS stage
        FROM orders WHERE o_orderstatus <> 'P'
          AND 'C' || o_custkey IN (SELECT individual FROM restricted)""",
)
def scrub_audit(spark, sf_dir):
    files = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), text("o_custkey")).alias("individual"),
        case("o_orderstatus", _STATUS_TYPES).alias("analysis_type"),
        F.when(F.col("o_totalprice") > 250000, "output").otherwise("input").alias("stage"),
    )
    return restriction.scrub_audit(_restricted(spark, sf_dir), files)


def report_files(spark, sf_dir):
    """Purchases and views as report folders of their users."""
    events = table(spark, sf_dir, "events").filter("event_type IN ('purchase', 'view')")
    path = F.concat(F.lit("/out/U"), text("user_id"), F.lit("/multiqc"))
    return events.select(case("event_type", TYPE_OF_EVENT).alias("analysis_type"), path.alias("path"))


@query(
    "processed",
    f"""SELECT {case_sql("event_type", TYPE_OF_EVENT)} AS analysis_type, 'U' || user_id AS individual
        FROM events WHERE event_type IN ('purchase', 'view')""",
)
def processed(spark, sf_dir):
    return housekeeping.processed_individuals(report_files(spark, sf_dir))


@query(
    "processed_unique",
    """SELECT DISTINCT 'U' || user_id AS individual FROM events
       WHERE event_type IN ('purchase', 'view')""",
)
def processed_unique(spark, sf_dir):
    return housekeeping.unique_individuals(processed(spark, sf_dir))


@query(
    "processed_counts",
    f"""SELECT code AS analysis_type, count(event_id) AS n_processed
        FROM (VALUES ('TF'), ('TM'), ('SG'), ('RP'), ('RM'), ('YC'), ('IM'), ('BL')) t(code)
        LEFT JOIN (SELECT event_id, {case_sql("event_type", TYPE_OF_EVENT)} AS kind FROM events
                   WHERE event_type IN ('purchase', 'view')) ON code = kind GROUP BY 1""",
)
def processed_counts(spark, sf_dir):
    types = fixed_table(spark, [(code,) for code in V.ANALYSIS_TYPES], "analysis_type string")
    return housekeeping.processed_counts(report_files(spark, sf_dir), types)


def _result_directories(spark, sf_dir):
    """Pages as result directories of hosts; the language stands for the analysis type."""
    url = F.col("url")
    name = F.when(url.contains("?"), "/work").when(url.contains("#"), "/pipeline_info")
    return table(spark, sf_dir, "pages").select(
        F.split_part(url, F.lit("/"), F.lit(3)).alias("individual"),
        F.when(url.contains("/en/"), "TF")
        .when(url.contains("/fr/"), "SG")
        .otherwise("XX")
        .alias("analysis_type"),
        F.concat(url, name.otherwise("/workflow")).alias("path"),
    )


def _listed(spark, sf_dir):
    """Hosts that some longer page belongs to."""
    pages = table(spark, sf_dir, "pages").filter(F.length("html") > 1000)
    return pages.select(F.split_part("url", F.lit("/"), F.lit(3)).alias("id"))


_DIRECTORIES_SQL = """directories AS (
    SELECT split_part(url, '/', 3) AS individual,
           CASE WHEN url LIKE '%/en/%' THEN 'TF' WHEN url LIKE '%/fr/%' THEN 'SG' ELSE 'XX' END
               AS analysis_type,
           url || CASE WHEN contains(url, '?') THEN '/work' WHEN contains(url, '#')
                       THEN '/pipeline_info' ELSE '/workflow' END AS path
    FROM pages),
listed AS (SELECT split_part(url, '/', 3) AS id FROM pages WHERE length(html) > 1000)"""


@query(
    "purge_plan",
    f"""WITH {_DIRECTORIES_SQL}
        SELECT * FROM directories WHERE analysis_type <> 'XX'
          AND individual IN (SELECT id FROM listed)
          AND NOT regexp_matches(path, '(^|[^A-Za-z0-9_])(work|1240k\\.imputed|GTL_output|pipeline_info)'
                                       || '([^A-Za-z0-9_]|$)')""",
)
def purge_plan(spark, sf_dir):
    return housekeeping.purge_plan(_listed(spark, sf_dir), _result_directories(spark, sf_dir))


@query(
    "work_directories",
    f"""WITH {_DIRECTORIES_SQL}
        SELECT * FROM directories WHERE analysis_type <> 'XX'
          AND individual IN (SELECT id FROM listed) AND suffix(path, '/work')""",
)
def work_directories(spark, sf_dir):
    return housekeeping.work_directories(_listed(spark, sf_dir), _result_directories(spark, sf_dir))


def _catalog(spark, sf_dir):
    """Purchases as published versions of their user's package."""
    version = F.concat_ws(
        ".", text(F.dayofmonth("ts")), text(F.hour("ts")), text((F.col("event_id") % 20))
    )
    return table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        text("user_id").alias("package_id"), version.alias("version"), "event_id"
    )


_CATALOG_SQL = """latest AS (
    SELECT DISTINCT ON (user_id) user_id, dayofmonth(ts) AS a, hour(ts) AS b, event_id % 20 AS c, event_id
    FROM events WHERE event_type = 'purchase'
    ORDER BY user_id, dayofmonth(ts) DESC, hour(ts) DESC, event_id % 20 DESC, event_id DESC)"""


@query(
    "latest_version",
    f"""WITH {_CATALOG_SQL}
        SELECT cast(user_id AS varchar) AS package_id, a || '.' || b || '.' || c AS version
        FROM latest""",
)
def latest_version(spark, sf_dir):
    return packages.latest_versions(_catalog(spark, sf_dir)).select("package_id", "version")


@query(
    "next_version",
    f"""WITH {_CATALOG_SQL}, everyone AS (SELECT DISTINCT user_id FROM events)
        SELECT cast(user_id AS varchar) AS package_id,
               CASE WHEN a IS NULL THEN '1.0.0' ELSE a || '.' || (b + 1) || '.0' END AS version,
               'New genotypes' AS log_text
        FROM everyone LEFT JOIN latest USING (user_id)""",
)
def next_version(spark, sf_dir):
    published = table(spark, sf_dir, "events").select(text("user_id").alias("package_id")).distinct()
    rows = packages.next_catalog_rows(
        _catalog(spark, sf_dir), published, "Minor", "New genotypes", F.current_timestamp()
    )
    return rows.select("package_id", "version", "log_text")


@query(
    "params",
    """WITH ranked AS (
           SELECT event_type AS analysis_type, user_id,
                  CASE WHEN value < 2 THEN NULL ELSE json_extract_string(props, '$.k') END AS value,
                  row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS place
           FROM events)
       SELECT analysis_type, 'setting_' || user_id AS key, value FROM ranked WHERE place = 1""",
)
def params(spark, sf_dir):
    """Events as parameter rows of ever later profiles; small values are explicit NULLs."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    rows = events.select(
        text("event_id").alias("profile"),
        F.concat(F.lit("setting_"), text("user_id")).alias("key"),
        F.when(F.col("value") >= 2, k).alias("value"),
    )
    order = events.select(
        text("event_id").alias("profile"),
        F.col("event_type").alias("analysis_type"),
        F.col("event_id").alias("precedence"),
    )
    return parameters.resolve_params(rows, order)
