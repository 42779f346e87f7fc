"""Quality results, sample metadata and sample indexes."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids, values
from cohortflow.operators import metadata, qc
from cohortflow.operators.numbering import number_rows
from cohortflow.queries.lab_tables import text
from cohortflow.queries.registry import query, table
from cohortflow.sources.results import explode_report


@query(
    "group_from_id",
    """SELECT c_custkey, CASE WHEN suffix(id, '_ss') THEN substr(id, 1, length(id) - 6)
                              ELSE substr(id, 1, length(id) - 3) END AS "Group_Name"
       FROM (SELECT c_custkey, c_mktsegment || lpad(cast(c_custkey % 1000 AS varchar), 3, '0')
                    || CASE WHEN c_acctbal < 0 THEN '_ss' ELSE '' END AS id FROM customer)""",
)
def group_from_id(spark, sf_dir):
    number = F.lpad(text(F.col("c_custkey") % 1000), 3, "0")
    suffix = F.when(F.col("c_acctbal") < 0, "_ss").otherwise("")
    people = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_mktsegment", number, suffix).alias("id")
    )
    return metadata.regroup(people, "id", "Group_Name").drop("id")


@query(
    "first_group",
    """SELECT s_suppkey, split_part(CASE WHEN s_acctbal < 0 THEN s_name
              ELSE n_name || ';' || s_name || ';x' END, ';', 1) AS "Population"
       FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def first_group(spark, sf_dir):
    nations = table(spark, sf_dir, "nation")
    suppliers = table(spark, sf_dir, "supplier")
    groups = F.when(F.col("s_acctbal") < 0, F.col("s_name")).otherwise(
        F.concat_ws(";", "n_name", "s_name", F.lit("x"))
    )
    return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", ids.first_group(groups).alias("Population")
    )


@query(
    "sex_codes",
    """SELECT l_orderkey, l_linenumber,
              CASE l_linenumber WHEN 1 THEN 'M' WHEN 2 THEN 'F' ELSE 'U' END AS decoded,
              CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '0' END AS encoded
       FROM lineitem""",
)
def sex_codes(spark, sf_dir):
    flag = F.col("l_returnflag")
    sex = F.when(flag == "A", "M").when(flag == "N", "F").otherwise("U")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        values.decode_sex(text("l_linenumber")).alias("decoded"),
        values.encode_sex(sex).alias("encoded"),
    )


@query(
    "textify",
    """SELECT coalesce(cast(c_custkey AS varchar), 'n/a') AS c_custkey,
              CASE WHEN c_custkey % 4 = 0 THEN 'n/a' ELSE c_name END AS c_name,
              c_mktsegment || ';' || c_nationkey AS names,
              CASE WHEN c_nationkey < 9 THEN 'haploid' ELSE 'diploid' END AS "Genotype_Ploidy"
       FROM customer""",
)
def textify(spark, sf_dir):
    people = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("c_name"),
        F.array("c_mktsegment", text("c_nationkey")).alias("names"),
        F.when(F.col("c_nationkey") >= 9, "diploid").alias("Genotype_Ploidy"),
    )
    return values.textify(values.fill_ploidy(people))


@query(
    "library_names",
    """SELECT l_suppkey, string_agg(name, ';' ORDER BY name) AS "Library_Names"
       FROM (SELECT DISTINCT l_suppkey, p_brand || '.A1' AS name
             FROM lineitem JOIN part ON l_partkey = p_partkey)
       GROUP BY 1""",
)
def library_names(spark, sf_dir):
    """Brands stand for libraries, some of them named twice: with and without the suffix."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_linestatus")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    suffix = F.when(F.col("l_linestatus") == "F", "_ss.A1").otherwise(".A1")
    named = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_suppkey", F.concat("p_brand", suffix).alias("name")
    )
    per_supplier = named.groupBy("l_suppkey").agg(F.collect_set("name").alias("names"))
    cleaned = ids.clean_library_names(F.col("names"))
    return per_supplier.select("l_suppkey", F.array_join(cleaned, ";").alias("Library_Names"))


@query(
    "classify_ratio",
    """SELECT l_orderkey, l_partkey,
              CASE WHEN x BETWEEN 0.7 AND 1.2 AND y BETWEEN 0.0 AND 0.1 THEN 'F'
                   WHEN x BETWEEN 0.2 AND 0.6 AND y BETWEEN 0.3 AND 0.6 THEN 'M' ELSE 'U' END AS sex
       FROM (SELECT l_orderkey, l_partkey, cast(l_quantity AS double) / 40 AS x,
                    cast(l_linenumber AS double) / 10 - 0.1 AS y FROM lineitem)""",
)
def classify_ratio(spark, sf_dir):
    x = F.col("l_quantity") / 40
    y = F.col("l_linenumber").cast("double") / 10 - 0.1
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", values.classify_sex(x, y).alias("sex")
    )


def _brand_libraries(spark, sf_dir):
    """Orders as samples, the brands of their parts as libraries, one row per specification."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    status, size = F.col("l_linestatus"), F.col("p_size") % 4
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(F.lit("O"), text("l_orderkey")).alias("Sample_Name"),
            F.col("p_brand").alias("Library_ID"),
            F.when(status == "F", "single").when(size != 3, "double").alias("Strandedness"),
            F.when(size == 0, "none").when(size == 1, "half").alias("UDG_Treatment"),
        )
        .distinct()
    )


_BRANDS_SQL = """brands AS (
    SELECT DISTINCT 'O' || l_orderkey AS sample, p_brand AS library,
           CASE WHEN l_linestatus = 'F' THEN 'single' WHEN p_size % 4 <> 3 THEN 'double' END AS strand,
           CASE p_size % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'half' END AS udg
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(
    "sample_summary",
    f"""WITH {_BRANDS_SQL}
        SELECT sample AS "Sample_Name", strand AS "Strandedness",
               CASE WHEN count(DISTINCT coalesce(udg, '-')) > 1 THEN 'mixed' ELSE min(udg) END AS "UDG",
               count(*) AS "Nr_Libraries",
               rtrim(repeat('1240K;', count(*)), ';') AS "Capture_Type",
               CASE strand WHEN 'single' THEN 'ss' WHEN 'double' THEN 'ds' END AS "Library_Built"
        FROM brands GROUP BY sample, strand""",
)
def sample_summary(spark, sf_dir):
    return qc.sample_summary(_brand_libraries(spark, sf_dir))


_MEASURED_SQL = """measured AS (
    SELECT 'O' || l_orderkey AS sample, p_brand AS library,
           CASE WHEN l_orderkey % 2 = 0 THEN 'single' ELSE 'double' END AS strand,
           CASE WHEN min(p_size) % 2 = 0 THEN 'half' ELSE 'none' END AS udg,
           CASE WHEN max(l_linenumber) <> 4 THEN max(l_quantity) / 40 END AS x_rate,
           CASE WHEN max(l_linenumber) <> 4 THEN 0.25::double END AS x_err,
           CASE WHEN max(l_linenumber) <> 4 THEN min(l_quantity) / 100 END AS y_rate,
           CASE WHEN max(l_linenumber) <> 4 THEN 0.125::double END AS y_err,
           count(*) * 1000 AS covered,
           cast(sum(l_linenumber) AS double) / 8 AS cont,
           cast(max(l_linenumber) AS double) / 16 AS cont_err,
           cast(sum(l_quantity) AS bigint) * 3 AS snps,
           cast(min(l_linenumber) AS double) / 4 AS damage, count(*) AS n_reads,
           max(l_quantity) / 2 AS endo
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand)"""


def _measured_libraries(spark, sf_dir):
    """Library rows as ``compile_qc`` gives them; weighted measures are exact binary fractions."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    per_brand = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey", "p_brand")
        .agg(
            F.min("p_size").alias("size"),
            F.max("l_quantity").alias("high"),
            F.min("l_quantity").alias("low"),
            F.count(F.lit(1)).alias("n"),
            F.sum("l_linenumber").alias("lines"),
            F.max("l_linenumber").alias("last"),
            F.min("l_linenumber").alias("first"),
            F.sum("l_quantity").cast("bigint").alias("quantity"),
        )
    )
    determined = F.col("last") != 4
    x, y = F.col("high") / 40, F.col("low") / 100
    return per_brand.select(
        F.concat(F.lit("O"), text("l_orderkey")).alias("Sample_Name"),
        F.col("p_brand").alias("Library_ID"),
        F.when(F.col("l_orderkey") % 2 == 0, "single").otherwise("double").alias("Strandedness"),
        F.when(F.col("size") % 2 == 0, "half").otherwise("none").alias("UDG_Treatment"),
        F.when(determined, x).alias("x_rate"),
        F.when(determined, 0.25).alias("x_err"),
        F.when(determined, y).alias("y_rate"),
        F.when(determined, 0.125).alias("y_err"),
        (F.col("n") * 1000).alias("covered_snps"),
        (F.col("lines") / 8).alias("contamination"),
        (F.col("last") / 16).alias("contamination_err"),
        (F.col("quantity") * 3).alias("contamination_snps"),
        (F.col("first") / 4).alias("damage"),
        F.col("n").alias("damage_reads"),
        (F.col("high") / 2).alias("endogenous"),
        F.when(determined, values.classify_sex(x, y)).alias("Genetic_Sex"),
    )


_ACROSS_SQL = f"""{_MEASURED_SQL},
sexed AS (
    SELECT *, CASE WHEN x_rate IS NULL THEN NULL
                   WHEN x_rate BETWEEN 0.7 AND 1.2 AND y_rate BETWEEN 0.0 AND 0.1 THEN 'F'
                   WHEN x_rate BETWEEN 0.2 AND 0.6 AND y_rate BETWEEN 0.3 AND 0.6 THEN 'M'
                   ELSE 'U' END AS sex FROM measured),
across_libs AS (
    SELECT sample AS "Sample_Name", max(sex) AS "Genetic_Sex",
           CASE WHEN max(x_rate) IS NOT NULL THEN printf('x-rate: %.3f +- %.3f, y-rate: %.3f +- %.3f',
               max(x_rate), max(x_err), max(y_rate), max(y_err)) END AS "Sex_Determination_Note",
           max(covered) AS "Nr_SNPs", max(endo) AS "Endogenous",
           sum(cont * snps) FILTER (snps >= 100) / sum(snps) FILTER (snps >= 100) AS "Contamination",
           sum(cont_err * snps) FILTER (snps >= 100) / sum(snps) FILTER (snps >= 100)
               AS "Contamination_Err",
           CASE WHEN count(*) FILTER (snps >= 100) > 0 THEN 'Nr Snps (per library): '
               || string_agg(cast(snps AS varchar), ';' ORDER BY library)
               || '. Estimate and error are weighted means of values per library.'
               || ' Libraries with fewer than 100 were excluded.' ELSE 'No results found.' END
               AS "Contamination_Note",
           CASE WHEN count(*) FILTER (snps >= 100) > 0 THEN 'ANGSD' END AS "Contamination_Meas",
           sum(damage * n_reads) / sum(n_reads) AS "Damage",
           CASE WHEN count(DISTINCT udg) > 1 THEN 'mixed' ELSE min(udg) END AS "UDG",
           count(*) AS "Nr_Libraries",
           string_agg(library, ';' ORDER BY library) AS "Library_Names",
           CASE min(strand) WHEN 'single' THEN 'ss' ELSE 'ds' END AS "Library_Built",
           rtrim(repeat('1240K;', count(*)), ';') AS "Capture_Type"
    FROM sexed GROUP BY sample)"""


def across(spark, sf_dir):
    results = qc.compile_across_libs(_measured_libraries(spark, sf_dir))
    return results.withColumn("Library_Names", F.array_join("Library_Names", ";"))


@query("across_libs", f"WITH {_ACROSS_SQL} SELECT * FROM across_libs")
def across_libs(spark, sf_dir):
    return across(spark, sf_dir)


@query(
    "compile_qc",
    """WITH sheets AS (
           SELECT 'C' || o_custkey AS "Sample_Name", 'L' || o_orderkey AS "Library_ID",
                  CASE o_orderstatus WHEN 'F' THEN 'single' ELSE 'double' END AS "Strandedness",
                  o_orderpriority AS "UDG_Treatment" FROM orders),
       sexdet AS (
           SELECT 'C' || c_custkey AS "Sample_Name", cast(c_custkey % 13 AS double) / 10 AS x_rate,
                  0.25::double AS x_err, cast(c_custkey % 7 AS double) / 10 AS y_rate,
                  0.5::double AS y_err FROM customer WHERE c_nationkey <> 3),
       snpcov AS (SELECT 'C' || c_custkey AS "Sample_Name", c_custkey * 10 AS covered_snps
                  FROM customer WHERE c_nationkey <> 4),
       nuccont AS (SELECT 'L' || o_orderkey AS "Library_ID", cast(o_orderkey % 9 AS double) / 8
                       AS contamination, 0.125::double AS contamination_err,
                       o_orderkey % 300 AS contamination_snps
                   FROM orders WHERE o_orderstatus <> 'P'),
       endogenous AS (SELECT 'L' || l_orderkey AS "Library_ID", max(l_quantity) AS endogenous
                      FROM lineitem GROUP BY l_orderkey)
       SELECT "Sample_Name", "Library_ID", "Strandedness", "UDG_Treatment", x_rate, x_err, y_rate,
              y_err, covered_snps, contamination, contamination_err, contamination_snps,
              cast(NULL AS double) AS damage, cast(NULL AS bigint) AS damage_reads, endogenous,
              CASE WHEN x_rate IS NULL THEN NULL
                   WHEN x_rate BETWEEN 0.7 AND 1.2 AND y_rate BETWEEN 0.0 AND 0.1 THEN 'F'
                   WHEN x_rate BETWEEN 0.2 AND 0.6 AND y_rate BETWEEN 0.3 AND 0.6 THEN 'M'
                   ELSE 'U' END AS "Genetic_Sex"
       FROM sheets LEFT JOIN sexdet USING ("Sample_Name") LEFT JOIN snpcov USING ("Sample_Name")
       LEFT JOIN nuccont USING ("Library_ID") LEFT JOIN endogenous USING ("Library_ID")""",
)
def compile_qc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    people = table(spark, sf_dir, "customer")
    person, order = F.col("c_custkey"), F.col("o_orderkey")
    sample = F.concat(F.lit("C"), text(person)).alias("Sample_Name")
    library = F.concat(F.lit("L"), text(order)).alias("Library_ID")
    sheets = orders.select(
        F.concat(F.lit("C"), text("o_custkey")).alias("Sample_Name"),
        library,
        F.when(F.col("o_orderstatus") == "F", "single").otherwise("double").alias("Strandedness"),
        F.col("o_orderpriority").alias("UDG_Treatment"),
    )
    sexdet = people.filter("c_nationkey <> 3").select(
        sample,
        ((person % 13).cast("double") / 10).alias("x_rate"),
        F.lit(0.25).alias("x_err"),
        ((person % 7).cast("double") / 10).alias("y_rate"),
        F.lit(0.5).alias("y_err"),
    )
    snpcov = people.filter("c_nationkey <> 4").select(sample, (person * 10).alias("covered_snps"))
    nuccont = orders.filter("o_orderstatus <> 'P'").select(
        library,
        ((order % 9).cast("double") / 8).alias("contamination"),
        F.lit(0.125).alias("contamination_err"),
        (order % 300).alias("contamination_snps"),
    )
    endogenous = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.concat(F.lit("L"), text("l_orderkey")).alias("Library_ID"))
        .agg(F.max("l_quantity").alias("endogenous"))
    )
    return qc.compile_qc(sheets, sexdet, snpcov, nuccont, endogenous=endogenous)


@query(
    "restrict_qc",
    """SELECT file, x_rate FROM (SELECT 'C' || c_custkey || '.trimmed.bam' AS file,
              cast(c_custkey % 13 AS double) / 10 AS x_rate FROM customer) q
       WHERE file IN (SELECT 'C' || o_custkey || '.trimmed.bam' FROM orders
                      WHERE o_orderstatus = 'P')""",
)
def restrict_qc(spark, sf_dir):
    sheets = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    named = qc.merged_read_names(
        sheets.select(
            F.concat(F.lit("C"), text("o_custkey")).alias("Sample_Name"),
            F.concat(F.lit("L"), text("o_orderkey")).alias("Library_ID"),
        )
    )
    results = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), text("c_custkey"), F.lit(".trimmed.bam")).alias("file"),
        ((F.col("c_custkey") % 13).cast("double") / 10).alias("x_rate"),
    )
    return qc.restrict_qc(results, named)


@query(
    "merged_names",
    """SELECT DISTINCT 'C' || o_custkey AS "Sample_Name", o_orderstatus AS "Strandedness",
              'L' || o_orderkey AS "Library_ID", 'L' || o_orderkey || '.trimmed.bam' AS library_file,
              'C' || o_custkey || '_' || o_orderstatus || '.trimmed.bam' AS merged_file FROM orders""",
)
def merged_names(spark, sf_dir):
    sheets = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), text("o_custkey")).alias("Sample_Name"),
        F.col("o_orderstatus").alias("Strandedness"),
        F.concat(F.lit("L"), text("o_orderkey")).alias("Library_ID"),
    )
    return qc.merged_read_names(sheets, grouping=("Sample_Name", "Strandedness"))


@query(
    "enrich_types",
    """WITH sg AS (SELECT o_custkey AS individual, max(o_totalprice) AS endogenous FROM orders
                   WHERE o_orderstatus = 'P' GROUP BY 1)
       SELECT o_orderkey, o_custkey AS individual, endogenous
       FROM orders LEFT JOIN sg ON o_custkey = individual WHERE o_orderstatus = 'F'""",
)
def enrich_types(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "individual")
    captured = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "individual")
    shotgun = (
        orders.filter("o_orderstatus = 'P'")
        .groupBy("individual")
        .agg(F.max("o_totalprice").alias("endogenous"))
    )
    return qc.enrich_across_types(captured, shotgun, ("endogenous",))


@query(
    "attach_lims",
    """SELECT c_name, s_name FROM (SELECT c_nationkey, c_name FROM customer WHERE c_nationkey < 20)
       FULL JOIN (SELECT s_nationkey, min(s_name) AS s_name FROM supplier WHERE s_nationkey > 4
                  GROUP BY 1) ON c_nationkey = s_nationkey""",
)
def attach_lims(spark, sf_dir):
    samples = table(spark, sf_dir, "customer").filter("c_nationkey < 20")
    lab = (
        table(spark, sf_dir, "supplier")
        .filter("s_nationkey > 4")
        .groupBy(F.col("s_nationkey").alias("individual"))
        .agg(F.min("s_name").alias("s_name"))
    )
    return metadata.attach_lims(
        samples.select(F.col("c_nationkey").alias("individual"), "c_name"), lab
    )


def _order_updates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    return orders.groupBy("o_custkey").agg(
        F.max("o_orderpriority").alias("c_mktsegment"),
        F.max(F.when(F.col("o_totalprice") > 300000, F.col("o_totalprice"))).alias("c_acctbal"),
        F.count(F.lit(1)).alias("n_orders"),
    )


_UPDATES_SQL = """updates AS (
    SELECT o_custkey, max(o_orderpriority) AS c_mktsegment,
           max(o_totalprice) FILTER (o_totalprice > 300000) AS c_acctbal, count(*) AS n_orders
    FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)"""


@query(
    "overwrite_join",
    f"""WITH {_UPDATES_SQL}
        SELECT c_custkey, c_name, c_nationkey, u.c_mktsegment, u.c_acctbal, u.n_orders
        FROM customer LEFT JOIN updates u ON c_custkey = o_custkey""",
)
def overwrite_join(spark, sf_dir):
    people = table(spark, sf_dir, "customer")
    return metadata.overwrite_join(people, _order_updates(spark, sf_dir), "c_custkey", "o_custkey")


@query(
    "overwrite_join_keep",
    f"""WITH {_UPDATES_SQL}
        SELECT c_custkey, c_name, c_nationkey, coalesce(u.c_mktsegment, c.c_mktsegment) AS c_mktsegment,
               coalesce(u.c_acctbal, c.c_acctbal) AS c_acctbal, u.n_orders
        FROM customer c LEFT JOIN updates u ON c_custkey = o_custkey""",
)
def overwrite_join_keep(spark, sf_dir):
    people = table(spark, sf_dir, "customer")
    updates = _order_updates(spark, sf_dir)
    return metadata.overwrite_join(people, updates, "c_custkey", "o_custkey", True)


_METADATA_COLUMNS = ", ".join(f'"{name}"' for name in V.RESULT_COLUMNS[1:])


@query(
    "update_metadata",
    f"""WITH {_ACROSS_SQL}
        SELECT 'O' || o_orderkey AS sample, o_orderpriority AS "Group_Name",
               {_METADATA_COLUMNS},
               CASE WHEN "Sample_Name" IS NOT NULL THEN o_totalprice END AS lab_value
        FROM orders LEFT JOIN across_libs ON "Sample_Name" = 'O' || o_orderkey""",
)
def update_metadata(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sample = F.concat(F.lit("O"), text("o_orderkey"))
    existing = orders.select(
        sample.alias("sample"),
        F.lit("U").alias("Genetic_Sex"),
        F.col("o_orderpriority").alias("Group_Name"),
        F.lit(0).cast("double").alias("Damage"),
    )
    lab = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey")
        .distinct()
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(sample.alias("individual"), F.col("o_totalprice").alias("lab_value"))
    )
    return metadata.update_metadata(existing, across(spark, sf_dir), lab, "sample")


@query(
    "sync_index",
    """SELECT 'S' || s_suppkey AS "Sample_Name", m.sex AS "Genetic_Sex",
              split_part(m.groups, ';', 1) AS "Population"
       FROM supplier LEFT JOIN (
           SELECT 'S' || c_custkey AS sample, CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS sex,
                  c_mktsegment || ';' || c_name AS groups
           FROM customer WHERE c_nationkey < 20) m ON sample = 'S' || s_suppkey""",
)
def sync_index(spark, sf_dir):
    index = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), text("s_suppkey")).alias("Sample_Name"),
        F.lit("U").alias("Genetic_Sex"),
        F.lit("Unknown").alias("Population"),
    )
    samples = (
        table(spark, sf_dir, "customer")
        .filter("c_nationkey < 20")
        .select(
            F.concat(F.lit("S"), text("c_custkey")).alias("sample"),
            F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("Genetic_Sex"),
            F.concat_ws(";", "c_mktsegment", "c_name").alias("Group_Name"),
        )
    )
    return metadata.sync_index(index, samples, "sample")


@query(
    "concat_index",
    """SELECT c_custkey AS pos, c_name AS sample FROM customer
       UNION ALL SELECT s_suppkey + (SELECT count(*) FROM customer), s_name FROM supplier""",
)
def concat_index(spark, sf_dir):
    double = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("pos"), F.col("c_name").alias("sample")
    )
    single = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("pos"), F.col("s_name").alias("sample")
    )
    return metadata.concat_indexes(double, single)


@query(
    "concat_index_keyed",
    """WITH placed AS (
           SELECT c_nationkey AS package_id, c_name AS sample,
                  row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS pos FROM customer),
       more AS (
           SELECT s_nationkey AS package_id, s_name AS sample,
                  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS pos FROM supplier)
       SELECT * FROM placed
       UNION ALL SELECT package_id, sample, pos + (SELECT count(*) FROM placed p WHERE p.package_id = more.package_id)
       FROM more""",
)
def concat_index_keyed(spark, sf_dir):
    """One index per nation: its customers, then its suppliers."""

    def index(name, nation, key, sample):
        rows = table(spark, sf_dir, name).select(F.col(nation).alias("package_id"), F.col(sample).alias("sample"), key)
        placed = number_rows(rows, ["package_id"], [key], "pos")
        return placed.select("package_id", "sample", (F.col("pos") - 1).alias("pos"))

    double = index("customer", "c_nationkey", "c_custkey", "c_name")
    single = index("supplier", "s_nationkey", "s_suppkey", "s_name")
    return metadata.concat_indexes(double, single, ["package_id"])


@query(
    "json_qc",
    """SELECT event_id, 'k' AS sample, cast(json_extract(props, '$.k') AS bigint) AS covered_snps
       FROM events""",
)
def json_qc(spark, sf_dir):
    """Each event's properties as a report of one entry, ``k``."""
    events = table(spark, sf_dir, "events")
    inner = F.concat(F.lit('{"covered_snps": '), F.get_json_object("props", "$.k"), F.lit("}"))
    report = F.concat(F.lit('{"'), text("event_id"), F.lit('": '), inner, F.lit("}"))
    rows = explode_report(events, report, "event_id", "covered_snps bigint")
    return rows.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.lit("k").alias("sample"), "covered_snps"
    )
