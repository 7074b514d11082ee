"""The registered queries of the pipeline operators, over whole tables, with their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklens.llm import bpe, decontaminate, html, jaccard, licenses, lines, pieces, prefixtrie, quality, spelling, substrings, toxicity, urlfilter
from ranklens.llm.shared import written

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, if it isn't installed there."""
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The public vocabulary file of the BPE query."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def piece_model() -> str:
    """The public model file of the SentencePiece query."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.component_ids(_table(spark, sf_dir, "documents"), n=4, percent=85)


#: The rules of the URL query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), RULES)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_table(spark, sf_dir, "documents"), vocabulary(), digests=True)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_matched", "n_windows", "n_slots")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.apply_policy(quality.ledger(_table(spark, sf_dir, "documents")), 2)
    base = F.col("failure_bits").bitwiseAND(F.lit(quality.policy_mask(1)).cast("long")) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept")


def held_out() -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxic_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model that the tables of ``sf_dir`` train."""
    return toxicity.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), usable=~held_out())


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.score(_table(spark, sf_dir, "documents"), toxic_weights(spark, sf_dir))
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def _op8_sql() -> str:
    given = ", ".join("('" + "', '".join([n, p]) + f"', {k})" for n, p, k in licenses.template_bigrams(licenses.TEMPLATES))
    return f"""
WITH t(license, bigram, n_template) AS (VALUES {given}),
d AS (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, text, CAST(i - 1 AS INTEGER) AS line, ls[i] AS x
      FROM (SELECT doc_id, text, ls, unnest(range(1, len(ls) + 1)) AS i FROM (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM d))
      UNION ALL SELECT doc_id, text, -1, text FROM d WHERE contains(text, chr(10))),
w AS (SELECT doc_id, text, line, regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+') AS ws FROM l),
b AS (SELECT DISTINCT doc_id, text, line, ws[i] || ' ' || ws[i + 1] AS bigram
      FROM (SELECT doc_id, text, line, ws, unnest(range(1, len(ws))) AS i FROM w)),
n AS (SELECT doc_id, text, line, count(*) AS n_text FROM b GROUP BY ALL),
c AS (SELECT doc_id, text, line, license, n_template, count(*) AS n_common FROM b JOIN t USING (bigram) GROUP BY ALL)
SELECT doc_id, line, license, n_common, CAST(2 * n_common AS DOUBLE) / (n_text + n_template) AS dice
FROM c JOIN n USING (doc_id, text, line) WHERE CAST(2 * n_common AS DOUBLE) / (n_text + n_template) >= 0.8
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_counts(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), digests=True)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(prefixtrie.sequences(prefixtrie.encoded_turns(_table(spark, sf_dir, "conversations"))), "conversations")
    conv = F.col("conv_id")
    return prefixtrie.prefix_trie(prefixtrie.rebuilt(found, conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9, 8))


#: crc32 of the bytes of ``w`` in DuckDB, which has no such function; ``tab``: ``_CRC_TABLE``.
_CRC_TABLE = "(SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"


def _crc32(w: str) -> str:
    byte = f"list_transform(range(octet_length(encode({w}))), lambda i: ('0x' || hex(encode({w}))[2 * i + 1 : 2 * i + 2])::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {byte}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


_OP11_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce("role", '') AS r, coalesce("text", '') AS x FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT conv_id, turn, sha256(length(r) || ':' || r || x) AS k, CAST(octet_length(encode(x)) AS BIGINT) AS b FROM t),
s AS (SELECT conv_id, list({{'k': k, 'b': b}} ORDER BY turn NULLS FIRST, k) AS l FROM u GROUP BY conv_id),
h AS (SELECT conv_id, l, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM s, {_CRC_TABLE}),
q AS (SELECT h.conv_id, coalesce(s.l[1:h.h], []) || h.l[h.h + 1:] AS l FROM h LEFT JOIN s ON s.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, d, l[1:d] AS node, len(l) = d AS ending, CASE WHEN d = 0 THEN 0 ELSE l[d].b END AS b FROM (SELECT *, unnest(range(len(l) + 1)) AS d FROM q)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(b) AS own,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ending), '')) AS ends FROM p GROUP BY node, d),
c AS (SELECT node[1:d - 1] AS node, count(*) AS n FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM n LEFT JOIN c USING (node)),
a AS (SELECT node[1:e] AS node, sum(own) AS saved, sum((n_children = 0)::INT) AS leaves FROM (SELECT *, unnest(range(d + 1)) AS e FROM m) GROUP BY 1)
SELECT m.conv_id, CAST(m.d AS BIGINT) AS depth, o.conv_id AS parent_conv_id, m.n_convs, CAST(m.n_children AS BIGINT) AS n_children,
       CAST(a.leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN a USING (node) LEFT JOIN m o ON m.d > 0 AND o.node = m.node[1:m.d - 1]
"""


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents"), piece_model(), digests=True)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(_table(spark, sf_dir, "documents")))


_OP13_SQL = f"""
WITH RECURSIVE g AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all("text", '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE "text" IS NOT NULL),
r AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n FROM g GROUP BY ALL),
k AS (SELECT id, w, n, id || ':' || w AS keyed FROM r WHERE length(w) >= 5),
c AS (SELECT w, n, {_crc32("keyed")} AS h FROM k, {_CRC_TABLE}),
d AS (SELECT CASE WHEN h % 97 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM c),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
x AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT DISTINCT x.word, x.n, v.word AS near, v.n AS near_n FROM x JOIN v ON v.word = x.rest),
p AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM x a JOIN x b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION ALL FROM e UNION ALL SELECT near, near_n, word, n FROM e),
t AS (SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM p QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
f AS (SELECT word, n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM t),
z AS (SELECT word, word AS root FROM v UNION ALL SELECT z.word, f.form FROM z JOIN f ON f.word = z.root AND f.form IS NOT NULL)
SELECT v.word, f.form, z.root, v.n, coalesce(f.n_near, 0) AS n_near, f.form_n
FROM v LEFT JOIN f USING (word) JOIN z ON z.word = v.word AND NOT EXISTS (SELECT 1 FROM f WHERE f.word = z.root AND f.form IS NOT NULL)
"""


_OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
e AS (SELECT DISTINCT doc_id, ws FROM d),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM e)),
f AS (SELECT g, min((doc_id, i)) AS first FROM w GROUP BY g),
r AS (SELECT DISTINCT doc_id, i FROM w JOIN f USING (g) WHERE (doc_id, i) <> first),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM r),
k AS (SELECT e.doc_id, p.i, e.ws[p.i] AS w
      FROM e, LATERAL (SELECT unnest(range(1, len(e.ws) + 1)) AS i) p
      WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = e.doc_id AND c.i = p.i)),
t AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS kept FROM k GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(t.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""

_OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
m AS (
  SELECT k, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         len(regexp_extract_all(text, '[A-Z]')) AS n_upper,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM w),
g AS (SELECT k, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c
      FROM (SELECT k, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT k, i FROM g QUALIFY count(*) OVER (PARTITION BY k, a, b, c) > 1),
p AS (SELECT k, count(DISTINCT i + j) AS n FROM r, (VALUES (0), (1), (2)) v(j) GROUP BY k),
x AS (SELECT doc_id, n_words, word_chars, n_symbols, n_upper, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
      FROM m LEFT JOIN p USING (k)),
y AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM x)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 8 * word_chars OR 100 * n_upper > 50 * word_chars
            OR 100 * n_dup_lines > 50 * n_lines OR 10 * word_chars < 20 * n_words OR word_chars > 40 * n_words) AS kept
FROM y
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_jaccard_join": (op1_jaccard_join, None),
    "op2_url_filter": (op2_url_filter, None),
    "op3_bpe": (op3_bpe, None),
    "op4_decontamination": (op4_decontamination, None),
    "op5_html_extraction": (op5_html_extraction, None),
    "op6_quality_rules": (op6_quality_rules, _OP6_SQL),
    "op8_license_scan": (op8_license_scan, _op8_sql()),
    "op9_line_dedup": (op9_line_dedup, None),
    "op10_substring_dedup": (op10_substring_dedup, _OP10_SQL),
    "op7_toxicity": (op7_toxicity, None),
    "op11_prefix_trie": (op11_prefix_trie, _OP11_SQL),
    "op12_sentencepiece": (op12_sentencepiece, None),
    "op13_spelling_variants": (op13_spelling_variants, _OP13_SQL),
}
