"""Line items as genotype calls: parts are SNPs, nations of suppliers are samples.

There are 25 nations at any scale, so a genotype line has at most 25 characters per package and
the matrices grow with the number of parts only.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.operators import genotypes, packages
from cohortflow.operators.numbering import spread
from cohortflow.queries.lab_tables import text
from cohortflow.queries.registry import query, table


def calls(spark, sf_dir):
    """Return flags are packages; open line items are double-stranded data, others single."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_returnflag").alias("package_id"),
        F.when(F.col("l_linestatus") == "O", "double").otherwise("single").alias("strand"),
        F.col("l_partkey").alias("snp_idx"),
        F.col("s_nationkey").cast("long").alias("pos"),
        text(F.col("l_linenumber") % 3).alias("call"),
    )


def _calls_sql(source: str = "lineitem") -> str:
    return f"""SELECT l_returnflag AS package_id, l_partkey AS snp_idx, s_nationkey AS pos,
           min(l_linenumber % 3) AS call
    FROM {source} JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"""


_CALLS_SQL = f"calls AS ({_calls_sql()})"


def _grid_sql(calls_table: str) -> str:
    """Every place of every line of a package, missing calls as 9."""
    return f"""SELECT package_id, snp_idx, pos, coalesce(cast(call AS varchar), '9') AS call
        FROM (SELECT DISTINCT package_id, snp_idx FROM {calls_table})
        CROSS JOIN (SELECT n_nationkey AS pos FROM nation)
        LEFT JOIN {calls_table} USING (package_id, snp_idx, pos)"""


def _lines_sql(calls_table: str) -> str:
    return f"""SELECT package_id, snp_idx, string_agg(call, '' ORDER BY pos) AS line
        FROM ({_grid_sql(calls_table)}) GROUP BY ALL"""


def n_samples(spark, sf_dir):
    return table(spark, sf_dir, "nation").agg(F.count(F.lit(1))).scalar()


def package_lines(spark, sf_dir, **options):
    return genotypes.to_geno_lines(
        calls(spark, sf_dir), n_samples(spark, sf_dir), ["package_id"], **options
    )


@query("geno_lines", f"WITH {_CALLS_SQL} {_lines_sql('calls')}")
def geno_lines(spark, sf_dir):
    return package_lines(spark, sf_dir)


@query("geno_lines_blocks", f"WITH {_CALLS_SQL} {_lines_sql('calls')}")
def geno_lines_blocks(spark, sf_dir):
    """The same lines put together from blocks of four samples."""
    return package_lines(spark, sf_dir, block=4)


@query("geno_long", f"WITH {_CALLS_SQL} {_grid_sql('calls')}")
def geno_long(spark, sf_dir):
    return genotypes.to_long(package_lines(spark, sf_dir), ["package_id"])


def _strands(spark, sf_dir):
    """Double- and single-stranded lines of all packages."""

    def lines(strand):
        of_strand = calls(spark, sf_dir).filter(F.col("strand") == strand)
        return genotypes.to_geno_lines(of_strand, n_samples(spark, sf_dir), ["package_id"])

    return lines("double"), lines("single")


_STRANDS_SQL = f"""
    double_items AS (SELECT * FROM lineitem WHERE l_linestatus = 'O'),
    single_items AS (SELECT * FROM lineitem WHERE l_linestatus <> 'O'),
    double_calls AS ({_calls_sql("double_items")}), single_calls AS ({_calls_sql("single_items")}),
    d AS ({_lines_sql("double_calls")}), s AS ({_lines_sql("single_calls")})"""


@query(
    "paste_geno",
    f"""WITH {_STRANDS_SQL}
        SELECT package_id, snp_idx, coalesce(d.line, '') || coalesce(s.line, '') AS line
        FROM d FULL JOIN s USING (package_id, snp_idx)""",
)
def paste_geno(spark, sf_dir):
    return genotypes.paste_genotypes(*_strands(spark, sf_dir), ["package_id"])


@query(
    "unpaired_lines",
    f"""WITH {_STRANDS_SQL}
        SELECT package_id, snp_idx, CASE WHEN s.line IS NULL THEN 'double' ELSE 'single' END AS only_in
        FROM d FULL JOIN s USING (package_id, snp_idx) WHERE s.line IS NULL OR d.line IS NULL""",
)
def unpaired_lines(spark, sf_dir):
    return genotypes.unpaired_lines(*_strands(spark, sf_dir), ["package_id"])


def forged(spark, sf_dir):
    """Three packages (return flags) merged; the SNP list covers parts no package has called."""
    snp = F.concat(F.lit("rs"), text("snp_idx"))
    genos = calls(spark, sf_dir).select(
        "package_id",
        snp.alias("snp_id"),
        F.concat(F.lit("N"), F.lpad(text("pos"), 2, "0")).alias("sample_id"),
        "call",
    )
    flags = F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R")))
    snps = table(spark, sf_dir, "part").select(
        flags.alias("package_id"),
        F.concat(F.lit("rs"), text("p_partkey")).alias("snp_id"),
        (F.col("p_size") % 22 + 1).alias("chrom"),
        F.lit(0.0).alias("genetic_pos"),
        F.col("p_partkey").alias("pos"),
        F.lit("A").alias("ref"),
        F.lit("G").alias("alt"),
    )
    inds = table(spark, sf_dir, "nation").select(
        flags.alias("package_id"),
        F.concat(F.lit("N"), F.lpad(text("n_nationkey"), 2, "0")).alias("sample_id"),
        F.lit("U").alias("sex"),
        F.lit("Unknown").alias("group"),
    )
    return genotypes.forge(genos, snps, genotypes.of_group(inds))


_FORGE_SQL = f"""WITH {_CALLS_SQL},
    snps AS (SELECT p_partkey, row_number() OVER (ORDER BY p_size % 22 + 1, p_partkey) - 1 AS snp_idx
             FROM part),
    samples AS (SELECT flag, n_nationkey FROM nation, (VALUES ('A'), ('N'), ('R')) f(flag))
    SELECT s.snp_idx, string_agg(coalesce(cast(c.call AS varchar), '9'), ''
                                 ORDER BY flag, n_nationkey) AS line
    FROM snps s CROSS JOIN samples
    LEFT JOIN calls c ON c.package_id = flag AND c.snp_idx = s.p_partkey AND c.pos = n_nationkey
    GROUP BY 1"""


@query("forge", _FORGE_SQL)
def forge(spark, sf_dir):
    return forged(spark, sf_dir)[0]


@query(
    "forge_snps",
    """SELECT 'rs' || p_partkey AS snp_id, p_size % 22 + 1 AS chrom, p_partkey AS pos,
              row_number() OVER (ORDER BY p_size % 22 + 1, p_partkey) - 1 AS snp_idx FROM part""",
)
def forge_snps(spark, sf_dir):
    return forged(spark, sf_dir)[1].select("snp_id", "chrom", "pos", "snp_idx")


@query(
    "forge_samples",
    """SELECT flag AS package_id, 'N' || lpad(cast(n_nationkey AS varchar), 2, '0') AS sample_id,
              row_number() OVER (ORDER BY flag, n_nationkey) - 1 AS pos
       FROM nation, (VALUES ('A'), ('N'), ('R')) f(flag)""",
)
def forge_samples(spark, sf_dir):
    return forged(spark, sf_dir)[2].select("package_id", "sample_id", "pos")


# A package outside the group; exchanged alleles and other alleles in some SNPs of some packages; and chromosomes as text, whose
# order is that of the genome. Package R lists only some of the parts.
_CHROM = "CASE p_size % 5 WHEN 0 THEN 'X' WHEN 1 THEN 'chr2' WHEN 2 THEN '11' WHEN 3 THEN 'MT' ELSE 'Y' END"
_RANK = "CASE p_size % 5 WHEN 0 THEN 1001 WHEN 1 THEN 2 WHEN 2 THEN 11 WHEN 3 THEN 1003 ELSE 1002 END"
_CHANGE = """CASE WHEN flag = 'N' AND p_partkey % 4 = 0 THEN 'swap' WHEN flag = 'R' AND p_partkey % 9 = 0 THEN 'drop' END"""
_MIXED_SQL = f"""WITH {_CALLS_SQL},
    flags AS (SELECT flag FROM (VALUES ('A'), ('N'), ('R'), ('Z')) f(flag)),
    snps AS (SELECT p_partkey, row_number() OVER (ORDER BY {_RANK}, {_CHROM}, p_partkey) - 1 AS snp_idx,
                    {_CHROM} AS chrom FROM part),
    samples AS (SELECT flag, n_nationkey FROM nation, flags WHERE flag <> 'Z' AND NOT (flag = 'A' AND n_nationkey % 5 = 0)),
    turned AS (
        SELECT flag, p_partkey, pos, CASE WHEN {_CHANGE} = 'swap' THEN 2 - call ELSE call END AS call
        FROM calls JOIN part ON snp_idx = p_partkey JOIN flags ON package_id = flag
        WHERE {_CHANGE} IS DISTINCT FROM 'drop' AND NOT (flag = 'R' AND p_partkey % 10 = 7)),
    lines AS (
        SELECT s.snp_idx, string_agg(coalesce(cast(c.call AS varchar), '9'), '' ORDER BY samples.flag, n_nationkey) AS line
        FROM snps s CROSS JOIN samples
        LEFT JOIN turned c ON c.flag = samples.flag AND c.p_partkey = s.p_partkey AND c.pos = n_nationkey
        GROUP BY 1)"""


def mixed_packages(spark, sf_dir):
    """SNP lists and samples of four packages, one of them of another group."""
    flags = F.explode(F.array(*map(F.lit, "ANRZ")))
    key, flag = F.col("p_partkey"), F.col("package_id")
    swapped, other = (flag == "N") & (key % 4 == 0), (flag == "R") & (key % 9 == 0)
    snps = table(spark, sf_dir, "part").select(flags.alias("package_id"), "p_partkey", "p_size")
    snps = snps.filter(~((flag == "R") & (key % 10 == 7))).select(
        "package_id",
        key.alias("snp_idx"),
        F.concat(F.lit("rs"), text("p_partkey")).alias("snp_id"),
        F.element_at(F.array(*map(F.lit, ("X", "chr2", "11", "MT", "Y"))), F.col("p_size") % 5 + 1).alias("chrom"),
        F.lit(0.0).alias("genetic_pos"),
        key.alias("pos"),
        F.when(swapped, "G").otherwise("A").alias("ref"),
        F.when(swapped, "A").when(other, "T").otherwise("G").alias("alt"),
    )
    inds = table(spark, sf_dir, "nation").select(
        flags.alias("package_id"),
        F.col("n_nationkey").cast("long").alias("pos"),
        F.concat(F.lit("N"), F.lpad(text("n_nationkey"), 2, "0")).alias("sample_id"),
    )
    # Of package A some samples are no members, and all of Z are of another group.
    chosen = inds.withColumn("group", F.when(F.col("package_id") == "Z", "Elsewhere").otherwise("Unknown"))
    return snps, chosen.filter(~((F.col("package_id") == "A") & (F.col("pos") % 5 == 0)))


@query(
    "forge_mixed",
    f"{_MIXED_SQL} SELECT 'rs' || p_partkey AS snp_id, chrom, snp_idx, line FROM lines JOIN snps USING (snp_idx)",
)
def forge_mixed(spark, sf_dir):
    """Calls of packages that differ in alleles, SNPs and samples; only those of the group are merged."""
    snps, inds = mixed_packages(spark, sf_dir)
    inds = genotypes.of_group(inds)
    members = inds.select("package_id").distinct()
    genos = calls(spark, sf_dir).select(
        "package_id",
        F.concat(F.lit("rs"), text("snp_idx")).alias("snp_id"),
        F.concat(F.lit("N"), F.lpad(text("pos"), 2, "0")).alias("sample_id"),
        "call",
    )
    # A package has no calls of SNPs that it does not list. Both sides are dealt by their number of rows, and stay so.
    line, rows = ["package_id", "snp_id"], genos.count()
    listed = spread(snps.select(*line), rows, line)
    genos = spread(genos, rows, line).join(listed.hint("shuffle_merge"), line, "left_semi")
    snps = snps.drop("snp_idx").join(members, "package_id", "left_semi")
    lines, snp_list, _ = genotypes.forge(genos, snps, inds.drop("pos"))
    return lines.join(snp_list, "snp_idx").select("snp_id", "chrom", "snp_idx", "line")


def _mixed_lines(spark, sf_dir):
    snps, inds = mixed_packages(spark, sf_dir)
    # Package Z has the lines of A, which must not be seen.
    own = package_lines(spark, sf_dir)
    other = own.filter("package_id = 'A'").withColumn("package_id", F.lit("Z"))
    return genotypes.forge_lines(own.unionByName(other), snps, genotypes.of_group(inds))


@query(
    "forge_lines",
    f"{_MIXED_SQL} SELECT 'rs' || p_partkey AS snp_id, chrom, snp_idx, line FROM lines JOIN snps USING (snp_idx)",
)
def forge_lines(spark, sf_dir):
    """The same from text matrices, whose lines are put together whole."""
    lines, snp_list, _ = _mixed_lines(spark, sf_dir)
    return lines.join(snp_list, "snp_idx").select("snp_id", "chrom", "snp_idx", "line")


@query(
    "forge_lines_samples",
    f"""{_MIXED_SQL} SELECT flag AS package_id, 'N' || lpad(cast(n_nationkey AS varchar), 2, '0') AS sample_id,
               row_number() OVER (ORDER BY flag, n_nationkey) - 1 AS pos, 'Unknown' AS "group" FROM samples""",
)
def forge_lines_samples(spark, sf_dir):
    return _mixed_lines(spark, sf_dir)[2].select("package_id", "sample_id", "pos", "group")


def in_order():
    """The calls of a short line, one after the other."""
    placed = F.array_sort(F.collect_list(F.struct("pos", "call")))
    return F.array_join(F.transform(placed, lambda one: one["call"]), "")


@query(
    "validate",
    f"""WITH {_CALLS_SQL},
        widths AS (SELECT package_id, snp_idx, count(*) AS width,
                          bool_or(call = 2) AS illegal FROM calls GROUP BY ALL),
        lines AS (SELECT package_id, count(*) AS n_lines, min(width) AS narrow, max(width) AS wide,
                         count(*) FILTER (illegal) AS illegal FROM widths GROUP BY 1),
        snps AS (SELECT l_returnflag AS package_id, count(DISTINCT l_partkey) AS n,
                        count(DISTINCT (l_partkey, l_linenumber)) AS n_rows FROM lineitem GROUP BY 1),
        inds AS (SELECT l_returnflag AS package_id, count(DISTINCT s_nationkey) AS n
                 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
        SELECT package_id, check_name AS "check", expected, found, expected = found AS ok FROM (
            SELECT package_id, 'snps_match_lines' AS check_name, n_rows AS expected, n_lines AS found
            FROM lines JOIN snps USING (package_id)
            UNION ALL SELECT package_id, 'samples_match_width', n,
                             CASE WHEN narrow <> n THEN narrow ELSE wide END
            FROM lines JOIN inds USING (package_id)
            UNION ALL SELECT package_id, 'samples_are_unique', 0, 0 FROM lines
            UNION ALL SELECT package_id, 'snps_are_unique', 0, n_rows - n FROM snps
            UNION ALL SELECT package_id, 'calls_are_legal', 0, illegal FROM lines)""",
)
def validate(spark, sf_dir):
    """Packages with short lines, repeated SNPs and calls outside a smaller alphabet."""
    single = calls(spark, sf_dir).groupBy("package_id", "snp_idx", "pos").agg(
        F.min("call").alias("call")
    )
    lines = single.groupBy("package_id", "snp_idx").agg(
        in_order().alias("line")
    )
    snps = (
        table(spark, sf_dir, "lineitem")
        .select(F.col("l_returnflag").alias("package_id"), "l_partkey", "l_linenumber")
        .distinct()
        .select("package_id", F.col("l_partkey").alias("snp_id"))
    )
    inds = single.select("package_id", F.col("pos").alias("sample_id")).distinct()
    return packages.validate_package(lines, snps, inds, calls=("0", "1", "9"))


@query(
    "checksum_rows",
    "SELECT doc_id, octet_length(encode(text)) AS length, md5(text) AS md5 FROM documents",
)
def checksum_rows(spark, sf_dir):
    """Documents as files: the whole text is hashed."""
    content = F.encode("text", "UTF-8")
    files = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("path"),
        F.octet_length(content).cast("long").alias("length"),
        content.alias("content"),
    )
    return packages.checksums(files).withColumnRenamed("path", "doc_id")
