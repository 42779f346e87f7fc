"""Read-level operators: documents as reads, line items as mapped reads, parts as targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.operators import coverage, parameters, reads
from cohortflow.queries.lab_tables import text
from cohortflow.queries.registry import query, table


def _document_reads(spark, sf_dir):
    """Whole texts as read sequences, sources as libraries."""
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("library_id"),
        F.col("doc_id").alias("read_id"),
        (F.col("n_chars") % 40 - 2).alias("mapq"),
        (F.col("lang") != "fr").alias("is_mapped"),
        F.col("doc_id").alias("pos"),
        F.col("text").alias("seq"),
    )


@query(
    "read_filter",
    """SELECT doc_id AS read_id, md5(text) AS seq FROM documents
       WHERE lang <> 'fr' AND n_chars % 40 - 2 >= 0 AND length(text) >= 30""",
)
def read_filter(spark, sf_dir):
    kept, _ = reads.filter_reads(_document_reads(spark, sf_dir))
    return kept.select("read_id", F.md5("seq").alias("seq"))


@query("read_unmapped", "SELECT doc_id AS read_id FROM documents WHERE lang = 'fr'")
def read_unmapped(spark, sf_dir):
    _, unmapped = reads.filter_reads(_document_reads(spark, sf_dir))
    return unmapped.select("read_id")


_CLIPPED = """WITH cut AS (
        SELECT doc_id, text, CASE WHEN source IN ('src0', 'src2') THEN 2
                                  WHEN source IN ('src1', 'src3') THEN 7 ELSE 0 END AS n
        FROM documents)
    SELECT doc_id AS read_id, doc_id + n AS pos, greatest(length(text) - 2 * n, 0) AS len,
           md5(substr(text, n + 1, greatest(length(text) - 2 * n, 0))) AS seq FROM cut"""


@query("clip", _CLIPPED)
def clip(spark, sf_dir):
    """Even and odd sources are half treated or untreated; others are single-stranded."""
    treated = F.when(F.col("library_id").isin("src0", "src2"), "half").when(
        F.col("library_id").isin("src1", "src3"), "none"
    )
    specs = (
        table(spark, sf_dir, "documents")
        .select(F.col("source").alias("library_id"))
        .distinct()
        .select(
            "library_id",
            F.lit("TF").alias("analysis_type"),
            F.when(treated.isNotNull(), "double").otherwise("single").alias("strandedness"),
            F.coalesce(treated, F.lit("half")).alias("udg"),
        )
    )
    params = parameters.resolve_params(
        parameters.default_profiles(spark), parameters.profile_order(spark)
    )
    lengths = parameters.clip_lengths(params)
    clipped = reads.clip_reads(_document_reads(spark, sf_dir), specs, lengths)
    return clipped.select(
        "read_id",
        "pos",
        F.length("seq").cast("long").alias("len"),
        F.md5("seq").alias("seq"),
    )


@query(
    "downsample",
    """SELECT event_type AS library_id, event_id AS read_id FROM (
           SELECT event_type, event_id, row_number() OVER (
               PARTITION BY event_type ORDER BY md5(event_id || '|7')) AS place FROM events)
       WHERE place <= 500""",
)
def downsample(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("library_id"), F.col("event_id").alias("read_id")
    )
    return reads.downsample(events, n=500, seed="7")


@query(
    "mt_ratio",
    """SELECT l_suppkey AS library_id, count(*) FILTER (l_returnflag = 'A') AS mt_reads,
              count(*) FILTER (l_returnflag <> 'A') AS nuclear_reads,
              cast(count(*) FILTER (l_returnflag = 'A') AS double)
                  / nullif(count(*) FILTER (l_returnflag <> 'A'), 0) AS mt_nuc_ratio
       FROM lineitem GROUP BY 1""",
)
def mt_ratio(spark, sf_dir):
    chrom = F.when(F.col("l_returnflag") == "A", "MT").otherwise(F.col("l_returnflag"))
    mapped = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("library_id"), chrom.alias("chrom")
    )
    return reads.mt_nuc_ratio(mapped)


def _chrom(code):
    return F.when(code == 0, "X").when(code == 1, "Y").otherwise("1")


def _mapped(spark, sf_dir):
    """Line items as reads that start at their part and are as long as their quantity."""
    start = F.col("l_partkey")
    return table(spark, sf_dir, "lineitem").select(
        _chrom(F.col("l_linenumber") % 4).alias("chrom"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("long") - 2).alias("end"),
    )


def _targets(spark, sf_dir):
    """Parts as target intervals as long as their size; some lie beyond every read."""
    start = F.col("p_partkey") * 2
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        _chrom(F.col("p_partkey") % 5).alias("chrom"),
        start.alias("start"),
        (start + F.col("p_size")).alias("end"),
    )


_COVERAGE_SQL = """
mapped AS (
    SELECT CASE l_linenumber % 4 WHEN 0 THEN 'X' WHEN 1 THEN 'Y' ELSE '1' END AS chrom,
           l_partkey AS s, l_partkey + cast(l_quantity AS bigint) - 2 AS e
    FROM lineitem WHERE cast(l_quantity AS bigint) > 2),
targets AS (
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'X' WHEN 1 THEN 'Y' ELSE '1' END AS chrom,
           p_partkey * 2 AS s, p_partkey * 2 + p_size AS e FROM part),
spans AS (SELECT chrom, s, e, count(*) AS n FROM mapped GROUP BY ALL),
depth AS (SELECT chrom, p, sum(n) AS d
          FROM (SELECT chrom, unnest(range(s, e)) AS p, n FROM spans) GROUP BY ALL),
covered AS (
    SELECT p_partkey, count(d) AS covered, coalesce(sum(d), 0) AS bases
    FROM (SELECT p_partkey, chrom, unnest(range(s, e)) AS p FROM targets)
    LEFT JOIN depth USING (chrom, p) GROUP BY 1),
touching AS (
    SELECT p_partkey, sum(n) AS n FROM targets t
    JOIN spans r ON r.chrom = t.chrom AND r.s < t.e AND r.e > t.s GROUP BY 1),
coverage AS (
    SELECT p_partkey, t.chrom, t.s AS start, t.e AS "end",
           cast(coalesce(n, 0) AS bigint) AS n_reads, covered, cast(bases AS bigint) AS bases,
           t.e - t.s AS length, cast(covered AS double) / (t.e - t.s) AS breadth,
           cast(bases AS double) / (t.e - t.s) AS mean_depth
    FROM targets t JOIN covered USING (p_partkey) LEFT JOIN touching USING (p_partkey))"""


@query("coverage", f"WITH {_COVERAGE_SQL} SELECT * FROM coverage")
def interval_coverage(spark, sf_dir):
    return coverage.interval_coverage(_mapped(spark, sf_dir), _targets(spark, sf_dir))


@query("coverage_bins", f"WITH {_COVERAGE_SQL} SELECT * FROM coverage")
def interval_coverage_bins(spark, sf_dir):
    """The same depths with bins of seven positions, so that everything crosses bins."""
    return coverage.interval_coverage(
        _mapped(spark, sf_dir), _targets(spark, sf_dir), bin_width=7
    )


@query(
    "sex_rates",
    f"""WITH {_COVERAGE_SQL},
        density AS (SELECT chrom, cast(sum(n_reads) AS double) / sum(length) AS d
                    FROM coverage GROUP BY 1)
        SELECT (SELECT d FROM density WHERE chrom = 'X') / (SELECT d FROM density WHERE chrom = '1')
                   AS x_rate,
               (SELECT d FROM density WHERE chrom = 'Y') / (SELECT d FROM density WHERE chrom = '1')
                   AS y_rate""",
)
def sex_rates(spark, sf_dir):
    return reads.sex_rates(
        coverage.interval_coverage(_mapped(spark, sf_dir), _targets(spark, sf_dir))
    )


_LETTERS = "ACGT"


def _letter(code):
    return F.substr(F.lit(_LETTERS), (code % 4 + 1).cast("int"), F.lit(1))


@query(
    "haploid",
    """WITH good AS (
           SELECT l_suppkey, p_partkey,
                  substr('ACGT', cast(l_linenumber % 4 + 1 AS int), 1) AS base,
                  md5(l_orderkey || '-' || l_linenumber || '-' || l_partkey || '|0') AS digest,
                  substr('ACGT', cast(p_size % 4 + 1 AS int), 1) AS ref,
                  substr('ACGT', cast((p_size + 1) % 4 + 1 AS int), 1) AS alt
           FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE cast(l_quantity AS bigint) >= 25 AND cast(floor(l_extendedprice) AS bigint) % 60 >= 30),
       drawn AS (
           SELECT DISTINCT ON (l_suppkey, p_partkey) * FROM good WHERE base IN (ref, alt)
           ORDER BY l_suppkey, p_partkey, digest, base)
       SELECT l_suppkey AS sample_id, 'rs' || p_partkey AS snp_id, base,
              CASE WHEN base = ref THEN '2' ELSE '0' END AS call FROM drawn""",
)
def haploid(spark, sf_dir):
    bases = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("sample_id"),
        F.lit("1").alias("chrom"),
        F.col("l_partkey").alias("pos"),
        _letter(F.col("l_linenumber")).alias("base"),
        F.floor("l_quantity").cast("long").alias("mapq"),
        (F.floor("l_extendedprice").cast("long") % 60).alias("baseq"),
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey")).alias("read_id"),
    )
    snps = table(spark, sf_dir, "part").select(
        F.concat(F.lit("rs"), text("p_partkey")).alias("snp_id"),
        F.lit("1").alias("chrom"),
        F.col("p_partkey").alias("pos"),
        _letter(F.col("p_size")).alias("ref"),
        _letter(F.col("p_size") + 1).alias("alt"),
    )
    return reads.pseudo_haploid(bases, snps)
