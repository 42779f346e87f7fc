"""Each operator applied to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortflow.llm import (
    alignment,
    ann,
    languages,
    line_dedup,
    lm,
    mixing,
    ngram_join,
    packing,
    phrases,
    quality,
    secrets,
    substring_dedup,
    training_order,
)
from cohortflow.llm.registry import QUERIES, SQL, query, table
from cohortflow.session import scratch_path

__all__ = ["QUERIES", "SQL"]

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "op1_line_dedup",
    f"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), '{line_dedup.UPPER}', '{line_dedup.LOWER}') AS key FROM lines
), owned AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) > 1
), judged AS (
  SELECT doc_id, line, pos, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed LEFT JOIN owned USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
)
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return cut.select(
        F.col("whole.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


@query("op8_quality_rules")
def op8(spark, sf_dir):
    judged = quality.verdicts(table(spark, sf_dir, "documents"))
    return judged.select(
        *("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"),
        *("lang", "surprise", "low", "high"),
    )


@query(
    "op6_ngram_jaccard",
    r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)
), sizes AS (
  SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS d, doc_id AS r FROM documents
  UNION
  SELECT reach.d, links.b FROM reach JOIN links ON reach.r = links.a
)
SELECT sizes.doc_id, n AS n_shingles, min(r) AS component_id
FROM sizes JOIN reach ON sizes.doc_id = d GROUP BY ALL
""",
)
def op6(spark, sf_dir):
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query(
    "op5_substring_dedup",
    r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM words)
), starts AS (
  SELECT doc_id, p FROM windows WHERE s IN (SELECT s FROM windows GROUP BY s HAVING count(*) > 1)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS k FROM starts
), each AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS k FROM words
), marked AS (
  SELECT each.*, gone.k IS NOT NULL AS out FROM each LEFT JOIN gone USING (doc_id, k)
), cut AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE out) AS n_removed,
    string_agg(word, ' ' ORDER BY k) FILTER (WHERE NOT out) AS kept
  FROM marked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN cut USING (doc_id)
""",
)
def op5(spark, sf_dir):
    cut = substring_dedup.cut_passages(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op7_packing")
def op7(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


# Toxic documents go, poor ones become a fiftieth of the tokens, the others stay.
WEIGHTS = {"good": 0.98, "poor": 0.02, "toxic": 0.0}


def domain():
    """The domain of a row of ``labels``."""
    toxic, quality = F.col("toxic"), F.col("quality")
    return F.when(toxic == 1, "toxic").when(quality == 0, "poor").when(quality == 1, "good")


@query("op2_mixing")
def op2(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return mixing.mix_to_targets(docs, labels, domain(), WEIGHTS, "good").drop("row")


def _spans_sql(kind: str, rank: int, pattern: str, least: int, group: int) -> str:
    """Spans of one rule from the lengths of gaps and matches."""
    quoted = pattern.replace("'", "''")

    def lengths_of(k: int) -> str:
        found = f"regexp_extract_all(text, '(.*?)({quoted})', {k}, 's')"
        return f"list_transform({found}, lambda x: length(x))"

    lengths = f"{lengths_of(1)} AS g, {lengths_of(2)} AS m, {lengths_of(group)} AS v"
    return f"""
SELECT doc_id, unnest(list_transform(
    list_filter(range(1, len(g) + 1), lambda i: v[i] >= {least}),
    lambda i: {{'start': list_sum(g[1:i]) + coalesce(list_sum(m[1:i - 1]), 0), 'rank': {rank}, 'kind': '{kind}',
      'stop': list_sum(g[1:i]) + list_sum(m[1:i])}})) AS span
FROM (SELECT doc_id, {lengths} FROM documents)
"""


def _secrets_sql() -> str:
    parts = []
    for rank, rule in enumerate(secrets.RULES, 1):
        pattern = rule.pattern
        if rule.kind == "assign":
            # Either case spelled out: ignoring case would let other letters than A-Z match there.
            words = pattern[len("(?i:") : pattern.index(")")]
            either = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)
            pattern = f"(?:{either}{pattern[pattern.index(')'):]}"
        parts.append(_spans_sql(rule.kind, rank, pattern, rule.least, 3 if rule.grouped else 2))
    spans = " UNION ALL ".join(parts)
    listed = "list_transform({}, lambda x: x.kind || ':' || x.start || ':' || x.stop)"
    base = "list_filter(spans, lambda x: x.rank <= 3)"
    return f"""
WITH found AS (SELECT doc_id, list_sort(list(span)) AS spans FROM ({spans}) GROUP BY doc_id),
whole AS (SELECT documents.doc_id, coalesce(spans, []) AS spans FROM documents LEFT JOIN found USING (doc_id))
SELECT doc_id,
  CAST(len(list_filter(spans, lambda x: x.rank = 1)) AS BIGINT) AS n_assign,
  CAST(len(list_filter(spans, lambda x: x.rank = 2)) AS BIGINT) AS n_access,
  CAST(len(list_filter(spans, lambda x: x.rank = 3)) AS BIGINT) AS n_hex,
  sha256(coalesce(array_to_string({listed.format(base)}, ','), '')) AS base_sha256,
  coalesce(array_to_string({listed.format('spans')}, ','), '') AS spans
FROM whole
"""


@query("op9_secret_scan", _secrets_sql())
def op9(spark, sf_dir):
    scanned = secrets.scan_versions(table(spark, sf_dir, "documents"), scratch_path(spark, "ledger"))
    return secrets.report(scanned).withColumnRenamed("path", "doc_id")


@query("op10_lm_scores")
def op10(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return lm.katz_scores(table(spark, sf_dir, "documents"), held_out)


@query("op3_ann_search")
def op3(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORDER_KEY = 20240607


@query("op4_training_order")
def op4(spark, sf_dir):
    folder = scratch_path(spark, "training-order")
    count, shards = training_order.write_training_order(table(spark, sf_dir, "documents"), folder, ORDER_KEY)
    return training_order.read_training_order(shards, count, ORDER_KEY).drop("ids")


def _phrases_sql(least: int = 10, longest: int = 3, keep: int = 2000, cover_percent: int = 50) -> str:
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: w[i:i + {k - 1}])) AS g FROM words"
        for k in range(1, longest + 1)
    )
    return rf"""
WITH words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, '{phrases.UNKNOWN}') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), f AS (
  SELECT lang, k, g, count(*) AS a FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}
), cuts AS (
  SELECT lang, k, g, a, unnest(range(1, k)) AS c FROM f WHERE k > 1
), scored AS (
  SELECT cuts.*, x.a AS l, y.a AS r,
    (1000000::HUGEINT * cuts.a::HUGEINT * cuts.a::HUGEINT // (x.a::HUGEINT * y.a::HUGEINT))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:c] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[c + 1:]
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1
), inner_parts AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, k), lambda m: list_transform(range(1, k - m + 2),
    lambda i: g[i:i + m - 1])))) AS g FROM f
), covered AS (
  SELECT lang, g, max(a) AS most FROM inner_parts GROUP BY ALL
), left_over AS (
  SELECT weakest.* FROM weakest LEFT JOIN covered USING (lang, g) WHERE most IS NULL OR 100 * most < {cover_percent} * a
), ranked AS (
  SELECT *, array_to_string(g, ' ') AS phrase FROM left_over
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN sizes USING (lang) QUALIFY rank <= {keep}
"""


@query("op11_phrase_mining", _phrases_sql())
def op11(spark, sf_dir):
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    return alignment.align_tokens(table(spark, sf_dir, "documents"))


@query("op13_language_id")
def op13(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return languages.identify(table(spark, sf_dir, "documents"), held_out)
