"""Registered queries of the corpus operators: thin digests of their results, and DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmetric.llm import (
    decontaminate,
    kd_shards,
    langid,
    license_scan,
    merkle,
    mixing,
    ngram_join,
    pseudonyms,
    quality,
    spelling,
    topk,
    toxicity,
    url_filter,
)

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
MIX_WEIGHTS = [3.0, 1.0, 2.0]
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 1.5, 2.0, "mix"
SHARDS = 8
#: Demonstration key of the registered query; a real run passes its own secret.
PII_KEY = "registered-query"


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.ngram_jaccard_join(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return joined.select("doc_id", "n_shingles", "class_id", "component_id")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (document, benchmark item it holds)."""
    hit = decontaminate.contained_items(_table(spark, sf_dir, "documents", "doc_id", "text"),
                                        _table(spark, sf_dir, "benchmark", "item_id", "text"))
    return hit.select("doc_id", "item_id", "matched", F.col("n").alias("n_shingles"),
                      F.round("containment", 6).alias("containment"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score_toxicity(docs, model).select("doc_id", "toxic", "p_toxic", "severity", "grade")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages", "page_id", "url"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(license_scan.license_spans(_table(spark, sf_dir, "documents", "doc_id", "text")))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = langid.fit_language_model(langid.training_rows(docs))
    return langid.predict_languages(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    plan = mixing.mixing_plan(docs, mixing.by_code_point(docs, MIX_WEIGHTS), MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    sized = docs.select("doc_id", "source", "text", mixing.word_count(F.col("text")).alias("size"))
    return mixing.planned_repeats(sized, plan, MIX_SEED).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("size") * F.col("repeats")).alias("taken"))


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    done = pseudonyms.pseudonymise(docs, pseudonyms.key_table(spark, PII_KEY))
    return done.select("doc_id", "text", pseudonyms.pii_total("pii").alias("n_values"),
                       F.array_join(F.array_sort(F.map_keys("pii")), ",").alias("kinds"))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.kd_shards(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"), SHARDS, slots=True)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def _id_crc(*more: str):
    """Unsigned crc32 of the decimal id (with ``more`` texts or columns behind it); null for a null id."""
    return F.crc32(F.concat(F.col("doc_id").cast("string"), *more).cast("binary"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering deletes the line breaks of the texts whose id has an even crc32."""
    docs = _table(spark, sf_dir, "documents", *_LEAF)
    text = F.when(_id_crc() % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    altered = merkle.leaf_hash([*[F.col(c) for c in _LEAF[:-1]], text])
    return merkle.verified_manifest(docs, _LEAF, "source", "doc_id", altered).withColumnRenamed("id", "doc_id")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "n_chars")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality").where(~quality.held_out())
    machine = quality.fit_quality(docs, labels, meta=["n_chars"])
    return quality.score_quality(docs, machine, meta=["n_chars"]).select(
        "doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where 97 divides the crc32 of ``<doc_id>:<run>``, the run loses one letter."""
    def change(run):
        h = _id_crc(F.lit(":"), run)
        at = (h % F.char_length(run)).cast("int")
        return F.when(h % 97 == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
                      ).otherwise(run)

    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling.spelling_groups(spelling.word_counts(docs, change=change)).select(
        "word", "form", "root", "n", "n_near", "form_n")


_LEAF = ["doc_id", "source", "lang", "n_chars", "text"]

_OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
shared AS (SELECT g FROM e GROUP BY g HAVING count(*) > 1),
f AS (SELECT e.* FROM e JOIN shared USING (g)),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (
  SELECT a AS node, a AS reach FROM l UNION SELECT r.node, l.b FROM r JOIN l ON r.reach = l.a),
c AS (SELECT node, min(reach) AS component_id FROM r GROUP BY node),
k AS (SELECT s, min(doc_id) AS class_id FROM (SELECT doc_id, list_sort(s) AS s FROM s WHERE len(s) > 0) GROUP BY s)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(k.class_id, s.doc_id) AS class_id,
       coalesce(c.component_id, s.doc_id) AS component_id
FROM s LEFT JOIN c ON c.node = s.doc_id LEFT JOIN k ON k.s = list_sort(s.s)
"""

_OP2_SQL = r"""
WITH iw AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, least(len(w), 5) AS k,
        unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda p: array_to_string(w[p:p + least(len(w), 5) - 1], ' '))) AS g
      FROM iw WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n FROM i GROUP BY item_id),
dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
d AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda p: array_to_string(w[p:p + k - 1], ' '))) AS g
      FROM dw, (SELECT DISTINCT k FROM i) WHERE len(w) >= k)
SELECT doc_id, item_id, count(*) AS matched, any_value(n) AS n_shingles, round(count(*) / any_value(n), 6) AS containment
FROM d JOIN i USING (k, g) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n) * 75
"""

_OP4_SQL = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r(rule, h, q, v) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow'))
SELECT page_id, host, path,
  (SELECT rule FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) ORDER BY length(rule) DESC LIMIT 1) AS rule,
  coalesce((SELECT v FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)
            ORDER BY length(rule) DESC LIMIT 1), 'allow') AS verdict
FROM p
"""

_OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.v AS q, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT vec_id, v FROM v) q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM t WHERE rank <= 5
"""

_OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(md5(text), '')) AS k FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, [3.0, 1.0, 2.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) + 1]::DOUBLE AS w,
              2.0::DOUBLE * source_size AS cap FROM s0),
s2 AS (
  SELECT *, coalesce(sum(cap) OVER below, 0) AS capped, sum(w) OVER rest AS w_rest, sum(source_size) OVER () AS total
  FROM s1 WHERE source_size > 0
  WINDOW below AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lv AS (SELECT arg_min((1.5 * total - capped) / w_rest, cap / w) AS level FROM s2 WHERE (1.5 * total - capped) / w_rest <= cap / w),
t AS (SELECT s1.*, CASE WHEN level IS NULL THEN cap ELSE least(cap, w * level) END::DOUBLE AS target FROM s1, lv),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size + 1e-12) ELSE 0 END AS epochs FROM t),
o AS (SELECT d.*, e.source_size, e.target, e.epochs, greatest(0, e.target - e.epochs * e.source_size) AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k RANGE UNBOUNDED PRECEDING) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, d.k) AS here
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND (upto <= rest OR (upto - here < rest AND upto - rest <= rest - (upto - here)))
                    THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""

#: crc32 of a short text in SQL: a table from the polynomial, then one step a byte.
_CRC = """t AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) AS c
    FROM (SELECT unnest(range(256)) AS i)))"""


def _crc_sql(blob: str) -> str:
    return f"""xor(4294967295, list_reduce(list_transform(range(1, octet_length({blob}) + 1),
      lambda p: CAST('0x' || substr(hex({blob}), 2 * p - 1, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT))"""


_OP11_SQL = r"""
WITH RECURSIVE CRC,
f AS (
  SELECT *, CASE WHEN CRCOF % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered FROM documents, t),
h AS (
  SELECT doc_id, source, sha256(FIELDS || FIELD(text)) AS leaf, sha256(FIELDS || FIELD(altered)) AS altered_leaf FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM h),
n AS (
  SELECT source, 0 AS level, list(leaf ORDER BY i) AS d FROM r GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, CAST(ceil(len(d) / 3.0) AS BIGINT)),
                                           lambda j: sha256(array_to_string(d[3 * j + 1:3 * j + 3], '')))
  FROM n WHERE len(d) > 1),
s AS (SELECT source, d[1] AS subroot FROM n WHERE len(d) = 1),
o AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM s),
m AS (
  SELECT 0 AS level, list(subroot ORDER BY i) AS d FROM o
  UNION ALL
  SELECT level + 1, list_transform(range(0, CAST(ceil(len(d) / 3.0) AS BIGINT)),
                                   lambda j: sha256(array_to_string(d[3 * j + 1:3 * j + 3], '')))
  FROM m WHERE len(d) > 1),
lv AS (
  SELECT r.doc_id, r.source, r.i AS leaf_no, n.level, r.i // CAST(pow(3, n.level) AS BIGINT) AS j, n.d
  FROM r JOIN n ON r.source IS NOT DISTINCT FROM n.source WHERE len(n.d) > 1
  UNION ALL
  SELECT r.doc_id, r.source, r.i, 1000 + m.level, o.i // CAST(pow(3, m.level) AS BIGINT), m.d
  FROM r JOIN o ON r.source IS NOT DISTINCT FROM o.source, m WHERE len(m.d) > 1),
p AS (
  SELECT source, leaf_no, list({'b': array_to_string(d[j - j % 3 + 1:j], ''), 'a': array_to_string(d[j + 2:j - j % 3 + 3], '')}
                               ORDER BY level) AS path
  FROM lv GROUP BY source, leaf_no),
z AS (
  SELECT r.doc_id, r.leaf, r.altered_leaf, o.subroot, (SELECT d[1] FROM m WHERE len(d) = 1) AS root, coalesce(p.path, []) AS path
  FROM r JOIN o ON r.source IS NOT DISTINCT FROM o.source
  LEFT JOIN p ON p.source IS NOT DISTINCT FROM r.source AND p.leaf_no = r.i),
k AS (
  SELECT z.*, 0 AS step, altered_leaf AS now FROM z
  UNION ALL
  SELECT doc_id, leaf, altered_leaf, subroot, root, path, step + 1, sha256(path[step + 1].b || now || path[step + 1].a)
  FROM k WHERE step < len(path))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda x: x.b || x.a), '')) AS proof_sha256,
       now AS folded_root, now = root AS verified
FROM k WHERE step = len(path)
"""
for _name in ("altered", "text"):
    _OP11_SQL = _OP11_SQL.replace(f"FIELD({_name})", f"coalesce(octet_length(encode({_name})) || ':' || {_name}, '-')")
_OP11_SQL = _OP11_SQL.replace("FIELDS", " || ".join(
    f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')" for c in _LEAF[:-1]))
_OP11_SQL = _OP11_SQL.replace("CRCOF", _crc_sql("encode(CAST(doc_id AS VARCHAR))")).replace("CRC", _CRC)

_OP13_SQL = r"""
WITH RECURSIVE CRC,
o AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[A-Za-zÀ-ÿ]{5,}')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS c FROM o GROUP BY ALL),
h AS (SELECT run, c, CRCOF AS h FROM g, t),
w AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM h),
v AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
x AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v),
d AS (SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS cut FROM x),
e AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b
    ON a.p = b.p AND a.cut = b.cut AND length(a.word) = length(b.word) AND a.word <> b.word
  UNION
  SELECT d.word, v.word, v.n FROM d JOIN v ON d.cut = v.word
  UNION
  SELECT v.word, d.word, d.n FROM d JOIN v ON d.cut = v.word),
b AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, struct_pack(k := -other_n, w := other)) AS best
  FROM e GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
         CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM v LEFT JOIN b USING (word)),
r AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL
  SELECT r.word, r.next, f.form FROM r JOIN f ON r.next = f.word)
SELECT f.word, f.form, r.root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL
"""
_OP13_SQL = _OP13_SQL.replace("CRCOF", _crc_sql("encode(doc_id || ':' || run)")).replace("CRC", _CRC)

_QUERIES = {
    "op1_ngram_join": (op1_ngram_join, _OP1_SQL),
    "op2_decontaminate": (op2_decontaminate, _OP2_SQL),
    "op3_toxicity": (op3_toxicity, None),
    "op4_url_filters": (op4_url_filters, _OP4_SQL),
    "op5_license_scan": (op5_license_scan, None),
    "op6_langid": (op6_langid, None),
    "op7_topk": (op7_topk, _OP7_SQL),
    "op8_mixing": (op8_mixing, _OP8_SQL),
    "op9_pseudonyms": (op9_pseudonyms, None),
    "op10_kd_shards": (op10_kd_shards, None),
    "op11_merkle": (op11_merkle, _OP11_SQL),
    "op12_quality": (op12_quality, None),
    "op13_spelling": (op13_spelling, _OP13_SQL),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for k, (f, _) in _QUERIES.items()}
ORACLES: dict[str, str] = {k: s for k, (_, s) in _QUERIES.items() if s}
