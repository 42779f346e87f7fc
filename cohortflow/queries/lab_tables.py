"""The test tables seen as lab tables.

Customers are individuals, orders are libraries with their sequencing, line items are analyses of
it, nations are sites and regions are batches. The test tables hold no NULL, so missing values are
derived from keys. ``FLAT_SQL`` says the same as ``lab_tables`` followed by ``lims_flat``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.operators import lims
from cohortflow.queries.registry import table
from cohortflow.session import fixed_table

OLD_ROOT, NEW_ROOT = "/old", "/store"


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def individual_name(key: Column) -> Column:
    return F.concat(F.substring("c_mktsegment", 1, 3), F.lpad(text(key), 12, "0"))


INDIVIDUAL_SQL = "substr(c_mktsegment, 1, 3) || lpad(cast({key} AS varchar), 12, '0')"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Individuals with main IDs set, empty or unknown, and with known or unknown consent."""
    key = F.col("c_custkey")
    main = (
        F.when(key % 41 == 0, None)
        .when(key % 3 == 0, individual_name(key - key % 10))
        .otherwise("")
    )
    sensitive = F.when(key % 7 == 0, None).otherwise(key % 11 == 0)
    return table(spark, sf_dir, "customer").select(
        key.alias("id"),
        F.col("c_nationkey").alias("site"),
        individual_name(key).alias("full_individual_id"),
        main.alias("main_individual_id"),
        F.col("c_mktsegment").alias("organism"),
        sensitive.alias("ethically_culturally_sensitive"),
    )


CUSTOMERS_SQL = f"""
    SELECT c_custkey AS id, c_nationkey AS site,
           {INDIVIDUAL_SQL.format(key="c_custkey")} AS full_individual_id,
           CASE WHEN c_custkey % 41 = 0 THEN NULL
                WHEN c_custkey % 3 = 0
                    THEN {INDIVIDUAL_SQL.format(key="(c_custkey - c_custkey % 10)")}
                ELSE '' END AS main_individual_id,
           c_mktsegment AS organism,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 11 = 0 END
               AS ethically_culturally_sensitive
    FROM customer"""


def library_id() -> Column:
    """Library IDs with no dot or with two."""
    key = F.col("o_orderkey")
    dotted = F.concat(F.lit("C"), text("o_custkey"), F.lit(".A"), text(key), F.lit("."), text(key % 3))
    return F.when(key % 9 == 0, F.concat(F.lit("L"), text(key))).otherwise(dotted)


LIBRARY_SQL = """CASE WHEN o_orderkey % 9 = 0 THEN 'L' || o_orderkey
    ELSE 'C' || o_custkey || '.A' || o_orderkey || '.' || o_orderkey % 3 END"""


def run_id() -> Column:
    """Year and month of the order, as six digits."""
    return F.lpad(text(F.year("o_orderdate") * 100 + F.month("o_orderdate")), 6, "0")


def lab_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    lineitem = table(spark, sf_dir, "lineitem")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    people = customers(spark, sf_dir)
    order, status = F.col("o_orderkey"), F.col("o_orderstatus")
    sequencing = orders.select(
        order.alias("id"),
        order.alias("capture"),
        (order % 6).cast("int").alias("batch"),
        F.concat(F.lit("S"), text(order)).alias("sequencing_id"),
        run_id().alias("run_id"),
        F.concat(library_id(), F.lit(".S"), text(order)).alias("full_sequencing_id"),
        F.when(status == "F", "yes").when(status == "O", "no").alias("single_stranded"),
        F.when(order % 17 == 0, None).otherwise(order % 19 == 0).alias("exclude"),
    )
    supplier, line, flag = F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_returnflag")
    pipeline = (
        F.when(flag == "A", F.when(line % 2 == 0, "HUMAN_1240K").otherwise("Human_1240k"))
        .when(flag == "N", F.when(line % 2 == 0, "HUMAN_SHOTGUN").otherwise("Human_Shotgun"))
        .otherwise(F.when(line % 2 == 0, "HUMAN_TM").otherwise("Foreign"))
    )
    root = F.when(supplier % 2 == 0, OLD_ROOT).otherwise(NEW_ROOT)
    directory = F.concat(root, F.lit("/runs/"), text(supplier), F.lit("/"))
    analysis = lineitem.select(
        F.col("l_orderkey").alias("raw_data"),
        pipeline.alias("analysis_id"),
        F.when(supplier % 13 != 0, directory).alias("result_directory"),
        F.when(line == 7, "true").otherwise("false").alias("deleted"),
    )
    return {
        "site": nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")),
        "batch": region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "individual": people.drop("ethically_culturally_sensitive"),
        "sample": people.select(
            "id", F.col("id").alias("individual"), "ethically_culturally_sensitive"
        ),
        "extract": people.select("id", F.col("id").alias("sample")),
        "library": orders.select(
            order.alias("id"),
            F.col("o_custkey").alias("extract"),
            library_id().alias("full_library_id"),
            F.col("o_orderpriority").alias("protocol"),
        ),
        "capture": orders.select(order.alias("id"), order.alias("library")),
        "sequencing": sequencing,
        "raw_data": orders.select(order.alias("id"), order.alias("sequencing")),
        "analysis": analysis,
    }


FLAT_SQL = f"""
people AS ({CUSTOMERS_SQL}),
flat AS (
    SELECT p.full_individual_id, p.main_individual_id, p.organism,
           p.ethically_culturally_sensitive,
           {LIBRARY_SQL} AS full_library_id,
           o_orderpriority AS protocol,
           CASE l_returnflag
               WHEN 'A' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'HUMAN_1240K' ELSE 'Human_1240k' END
               WHEN 'N' THEN CASE WHEN l_linenumber % 2 = 0 THEN 'HUMAN_SHOTGUN'
                                  ELSE 'Human_Shotgun' END
               ELSE CASE WHEN l_linenumber % 2 = 0 THEN 'HUMAN_TM' ELSE 'Foreign' END
           END AS analysis_id,
           CASE WHEN l_suppkey % 13 <> 0
                THEN CASE WHEN l_suppkey % 2 = 0 THEN '{OLD_ROOT}' ELSE '{NEW_ROOT}' END
                     || '/runs/' || l_suppkey || '/' END AS result_directory,
           'S' || o_orderkey AS sequencing_id,
           strftime(o_orderdate, '%Y%m') AS run_id,
           {LIBRARY_SQL} || '.S' || o_orderkey AS full_sequencing_id,
           CASE o_orderstatus WHEN 'F' THEN 'yes' WHEN 'O' THEN 'no' END AS single_stranded,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 19 = 0 END AS exclude
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN people p ON o_custkey = p.id
    JOIN nation ON p.site = n_nationkey
    JOIN region ON o_orderkey % 6 = r_regionkey
    WHERE l_linenumber <> 7
)"""

KEPT_SQL = f"""{FLAT_SQL},
names(analysis_id, analysis_type) AS (VALUES
    ('HUMAN_1240K', 'TF'), ('Human_1240k', 'TF'), ('HUMAN_SHOTGUN', 'SG'), ('Human_Shotgun', 'SG'),
    ('HUMAN_TM', 'TM')),
kept AS (
    SELECT flat.*, analysis_type FROM flat JOIN names USING (analysis_id)
    WHERE ethically_culturally_sensitive = false AND (exclude = false OR exclude IS NULL)
)"""


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lims.lims_flat(lab_tables(spark, sf_dir))


def kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows with their analysis type, consented and not excluded."""
    return lims.with_analysis_type(lims.not_excluded(lims.consented(flat(spark, sf_dir))))


def latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the last calendar year in the data: the runs to prepare."""
    orders = table(spark, sf_dir, "orders")
    year = orders.agg(F.year(F.max("o_orderdate"))).scalar()
    return orders.filter(F.year("o_orderdate") == year).select(run_id().alias("run_id")).distinct()


RUNS_SQL = """
years AS (SELECT max(strftime(o_orderdate, '%Y')) AS y FROM orders),
runs AS (SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS run_id FROM orders, years
         WHERE strftime(o_orderdate, '%Y') = y)"""


def protocols(spark: SparkSession) -> DataFrame:
    """Specs of four of the five protocols; one of them has no known treatment."""
    rows = [
        ("1-URGENT", "double", "half"),
        ("2-HIGH", "double", "none"),
        ("3-MEDIUM", "single", "Unknown"),
        ("4-NOT SPECIFIED", "double", "Unknown"),
    ]
    return fixed_table(spark, rows, "protocol string, strandedness string, udg string")


PROTOCOLS_SQL = """
protocols(protocol, strandedness, udg) AS (VALUES
    ('1-URGENT', 'double', 'half'), ('2-HIGH', 'double', 'none'),
    ('3-MEDIUM', 'single', 'Unknown'), ('4-NOT SPECIFIED', 'double', 'Unknown'))"""
