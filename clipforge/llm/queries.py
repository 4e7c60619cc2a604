"""Registered queries of the training-data operators, with their SQL where it can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipforge.llm import (
    decontaminate,
    importance,
    jaccard_join,
    language_cnn,
    licenses,
    line_dedup,
    merkle,
    minhash_forest,
    packing,
    quality_rules,
    source_audit,
    suffix_dedup,
    warc,
)
from clipforge.session import scratch_path
from clipforge.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@register("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@register("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@register("op3_jaccard_join")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_cnn.fit(docs.where(~language_cnn.held_out()))
    found = language_cnn.predict(docs, model)
    return found.select("doc_id", language_cnn.held_out().alias("held_out"), "lang_pred", "score")


@register("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("doc_key")


@register("op6_license_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@register("op7_importance_resampling")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where("quality is not null and toxic is not null")
    good = F.expr("quality = 1 and toxic = 0")
    share = labels.agg(F.avg(good.cast("double"))).first()[0]  # as many documents as are good where it is known
    return importance.resample(table(spark, sf_dir, "documents"), labels.where(good).select("doc_id"), share=1.0 if share is None else share)


@register("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, f"llm/archives-{uuid.uuid4().hex}")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path)


@register("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_line_dedup", sql=rf"""
WITH l AS (
  SELECT doc_id, source, unnest(list_distinct(string_split(text, chr(10)))) AS line
  FROM documents WHERE source IS NOT NULL AND text IS NOT NULL),
n AS (SELECT source, line, count(*) AS n FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
t AS (SELECT source, count(*) AS total FROM documents WHERE source IS NOT NULL GROUP BY ALL),
b AS (SELECT n.source, list(line) AS bad FROM n JOIN t USING (source)
      WHERE n.n > 1 AND n.n - {line_dedup.RATIO} * total > 0
        AND (n.n - {line_dedup.RATIO} * total) ** 2 > {line_dedup.SIGNIFICANCE ** 2 * line_dedup.RATIO * (1 - line_dedup.RATIO)} * total GROUP BY ALL),
k AS (
  SELECT doc_id, documents.source, string_split(text, chr(10)) AS lines,
         list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(bad, []), x)) AS kept
  FROM documents LEFT JOIN b ON documents.source = b.source)
SELECT doc_id, source, array_to_string(kept, chr(10)) AS text,
       coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(lines) - len(kept), 0)::BIGINT AS n_dropped
FROM k
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


@register("op11_minhash_forest")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"))


_TERMS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


@register("op12_source_audit", sql=rf"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, doc_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERMS}')) AS term
  FROM documents),
v AS (SELECT lang, term FROM d GROUP BY ALL HAVING count(DISTINCT doc_id) >= {source_audit.MIN_DOCUMENTS}),
size AS (SELECT lang, count(*) AS v FROM v GROUP BY ALL),
grp AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
cell AS (SELECT lang, source, term, count(*) AS n FROM d JOIN v USING (lang, term) GROUP BY ALL),
full_cell AS (
  SELECT grp.lang, grp.source, v.term, coalesce(n, 0) AS n
  FROM grp JOIN v ON v.lang = grp.lang LEFT JOIN cell ON cell.lang = grp.lang AND cell.source = grp.source AND cell.term = v.term),
total AS (SELECT lang, source, sum(n) AS total FROM full_cell GROUP BY ALL),
p AS (
  SELECT lang, source, term, n, (1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * size.v)::HUGEINT)::HUGEINT AS p
  FROM full_cell JOIN total USING (lang, source) JOIN size USING (lang)),
lang_n AS (SELECT lang, term, sum(n) AS n FROM cell GROUP BY ALL),
lang_total AS (SELECT lang, sum(n) AS total FROM lang_n GROUP BY ALL),
q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * size.v)::HUGEINT)::HUGEINT AS q
  FROM lang_n JOIN lang_total USING (lang) JOIN size USING (lang)),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
term AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {source_audit.TOP}
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergences(table(spark, sf_dir, "documents"))


def _leaf(text: str) -> str:
    parts = [f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


@register("op13_merkle_manifest", sql=rf"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lowered,
         xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
             lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
             lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1)))) % 5 = 0 AS tampered
  FROM documents),
place AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaf),
node AS (
  SELECT 0 AS level, tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM place
  UNION ALL
  SELECT level, tree, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM (
    SELECT level + 1 AS level, tree, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM node WHERE n > 1 GROUP BY level, tree, pos // 16)),
sub AS (SELECT tree, level, h AS subroot FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, tree AS pos, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT level, pos, h, count(*) OVER () AS n FROM (
    SELECT level + 1 AS level, pos // 16 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM top WHERE n > 1 GROUP BY level, pos // 16)),
way AS (
  SELECT p.tree AS tree, p.pos AS leaf_pos, 0 AS step, p.pos AS pos, CASE WHEN tampered THEN lowered ELSE leaf END AS h, '' AS proof
  FROM place p
  UNION ALL
  SELECT w.tree, w.leaf_pos, w.step + 1, w.pos // 16,
         sha256(string_agg(CASE WHEN m.pos = w.pos THEN w.h ELSE m.h END, '' ORDER BY m.pos)),
         w.proof || coalesce(string_agg(m.h, '' ORDER BY m.pos) FILTER (m.pos <> w.pos), '')
  FROM way w JOIN node m ON m.tree = w.tree AND m.level = w.step AND m.pos // 16 = w.pos // 16 AND m.n > 1
  GROUP BY w.tree, w.leaf_pos, w.step, w.pos, w.h, w.proof),
half AS (SELECT way.tree, leaf_pos, way.h, proof FROM way JOIN sub ON sub.tree = way.tree AND sub.level = way.step),
rest AS (
  SELECT tree, leaf_pos, 0 AS step, tree AS pos, h, proof FROM half
  UNION ALL
  SELECT w.tree, w.leaf_pos, w.step + 1, w.pos // 16,
         sha256(string_agg(CASE WHEN m.pos = w.pos THEN w.h ELSE m.h END, '' ORDER BY m.pos)),
         w.proof || coalesce(string_agg(m.h, '' ORDER BY m.pos) FILTER (m.pos <> w.pos), '')
  FROM rest w JOIN top m ON m.level = w.step AND m.pos // 16 = w.pos // 16 AND m.n > 1
  GROUP BY w.tree, w.leaf_pos, w.step, w.pos, w.h, w.proof),
root AS (SELECT h AS root, level FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, rest.h AS folded_root, rest.h = root AS verified
FROM place JOIN sub ON sub.tree = place.tree CROSS JOIN root
JOIN rest ON rest.tree = place.tree AND rest.leaf_pos = place.pos AND rest.step = root.level
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)
