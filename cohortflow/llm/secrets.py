"""Secrets in versioned files, scanned once per content and rule version.

Method: every version of every path is addressed by the hash of its content (its blob). A ledger in the shared store
remembers which blob was scanned by which version of which rule, and what was found. A scan looks only at pairs of
blob and rule version that the ledger lacks, appends them, and joins findings back to all paths that hold the
blob. Only DataFrame functions are used.

Defined results: a missing text is an empty one. Spans are in code points, ends exclusive. Matches of a rule are
the leftmost that do not overlap; matches too short are dropped after that, so they still use up their text.
Repeated paths and rows are versions of their own. Copies are scanned once, whatever their number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow.llm.frames import written


@dataclass(frozen=True)
class Rule:
    """A match of ``pattern`` counts if its one group (if ``grouped``, else all of it) has ``least`` characters.

    ``quick`` is a pattern that every text with such a match holds, if there is one that is found faster.
    """

    kind: str
    pattern: str
    least: int = 1
    grouped: bool = False
    version: int = 1
    quick: str | None = None


ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

JWT = r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
# Only the first 'eyJ' of a run needs a try, as the others share what follows; so a run without a token is read once.
JWT_QUICK = (
    r"(?<![A-Za-z0-9_-])(?>[A-Za-z0-9_-]*?eyJ)[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8}"
)

PRIVATE_BEGIN = r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----"
# The key as well: to its closing line, or to the end of a text that has none.
PRIVATE = PRIVATE_BEGIN + r"(?s:.*?)(?:-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----|\z)"

BASE = (
    Rule("assign", ASSIGN, least=6, grouped=True),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, quick=r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", least=24, quick=r"[0-9a-f]{24}"),
)
MORE = (
    Rule("private", PRIVATE, version=2, quick=PRIVATE_BEGIN),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]+", least=40, quick=r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("jwt", JWT, version=2, quick=JWT_QUICK),
)
RULES = BASE + MORE

_SCANNED = "blob string, kind string, version int"
_FOUND = "blob string, kind string, version int, start long, end long"


def _matches(rule: Rule):
    """Lengths of the gap before, of the match and of its measured part, for each match of a rule in ``text``.

    The pattern is matched from where the last match ended, with the text between as a group of its own, so the
    lengths give the places.
    """
    anchored = rf"\G((?s:.*?))({rule.pattern})"

    def group(k: int):
        return F.transform(F.regexp_extract_all("text", F.lit(anchored), F.lit(k)), F.length)

    def row(one, place):
        return F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            place.alias("place"),
            one["gap"].alias("gap"),
            one["match"].alias("match"),
            (one["value"] >= rule.least).alias("counts"),
        )

    lengths = F.arrays_zip(
        group(1).alias("gap"), group(2).alias("match"), group(3 if rule.grouped else 2).alias("value")
    )
    wanted = F.array_contains("kinds", rule.kind) & F.col("text").rlike(rule.quick or rule.pattern)
    nothing = F.array(row({"gap": F.lit(0), "match": F.lit(0), "value": F.lit(0)}, F.lit(0)))
    # Without a match there is nothing to list; the quick look saves the slower passes.
    return F.when(wanted, F.transform(lengths, row)).otherwise(F.filter(nothing, lambda one: F.lit(False)))


def _scan(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, kind, version, start, end`` over ``blob, kinds, text``; a blob that comes twice gives equal rows."""
    # Equal rows of the input stay apart by a label of the row.
    labelled = texts.withColumn("copy", F.monotonically_increasing_id())
    each = labelled.select("blob", "copy", F.inline(F.concat(*map(_matches, rules))))
    so_far = Window.partitionBy("blob", "copy", "kind").orderBy("place")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = each.withColumn("end", F.sum(F.col("gap") + F.col("match")).over(so_far))
    start = (F.col("end") - F.col("match")).cast("long").alias("start")
    return ended.where("counts").select("blob", "kind", "version", start, F.col("end").cast("long"))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a ledger table; none if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_versions(
    versions: DataFrame,
    ledger: str,
    rules: tuple[Rule, ...] = RULES,
    path_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``path, blob, found``: one row per version, ``found`` its spans ``(start, rank, kind, end)`` in order.

    ``ledger`` is a folder that all executors reach; what the call scans is appended to its tables ``scanned`` and
    ``found``. Findings are written before the pairs are marked as scanned, so a call that is cut off scans again and
    findings may then be listed twice; they are read as distinct rows.
    """
    spark = versions.sparkSession
    picked = versions.select(
        F.col(path_column).alias("path"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    ).withColumn("row", F.xxhash64("path", "text"))
    addressed = written(picked.select("path", "row", F.sha2("text", 256).alias("blob")), "versions")

    wanted = F.array(*(F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules))
    seen = _read(spark, f"{ledger}/scanned", _SCANNED).distinct()
    blobs = addressed.groupBy("blob").agg(F.min("row").alias("row"))
    pairs = blobs.select("blob", "row", F.explode(wanted).alias("rule")).select("blob", "row", "rule.kind", "rule.version")
    unseen = written(pairs.join(seen, ["blob", "kind", "version"], "left_anti"), "unseen")
    due = unseen.groupBy("row", "blob").agg(F.collect_set("kind").alias("kinds"))
    # Rows are dealt by a hash of each version, so many copies of one blob do not meet here.
    texts = picked.select("row", "text").join(due, "row").select("blob", "kinds", "text")
    found = _scan(texts, rules)
    found.write.mode("append").parquet(f"{ledger}/found")
    unseen.select("blob", "kind", "version").write.mode("append").parquet(f"{ledger}/scanned")

    rank = F.array_position(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind")).cast("int")
    current = F.array_position(F.array(*(F.lit(f"{r.kind}:{r.version}") for r in rules)), F.concat_ws(":", "kind", "version"))
    listed = _read(spark, f"{ledger}/found", _FOUND).where(current > 0).distinct()
    by_blob = listed.groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("found")
    )
    return addressed.join(by_blob, "blob", "left").select("path", "blob", "found")


def report(scanned: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """``path``, a count per base kind, the digest of the base spans, and all spans as text."""
    found = F.coalesce("found", F.filter("found", lambda one: F.lit(False)))
    kinds = [rule.kind for rule in base]

    def text(spans):
        listed = F.transform(
            spans, lambda one: F.concat_ws(":", one["kind"], one["start"].cast("string"), one["end"].cast("string"))
        )
        return F.coalesce(F.array_join(listed, ","), F.lit(""))

    def only(*chosen: str):
        return F.filter(F.col("found"), lambda one: one["kind"].isin(*chosen))

    return scanned.withColumn("found", found).select(
        "path",
        *(F.greatest(F.coalesce(F.size(only(k)), F.lit(0)), F.lit(0)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(text(only(*kinds)), 256).alias("base_sha256"),
        text(F.col("found")).alias("spans"),
    )
