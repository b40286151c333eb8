"""Queries of this subpackage over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from quern.llm import decontaminate, fingerprints, jaccard_join, line_dedup, mixing, pii, secret_scan, suffix_dedup, token_counts, toxicity
from quern.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op6_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


_LEVEL = (
    "l{1} AS (SELECT sid, block, epoch, node * 2 + CASE WHEN row_number() OVER (PARTITION BY node ORDER BY CAST('0x' || substr(md5('mix-1:split:{0}:' || sid || ':' || block || ':' || epoch), 1, 15) AS BIGINT), "
    "sid, block, epoch) > ceil(count(*) OVER (PARTITION BY node) / 2.0) THEN 1 ELSE 0 END AS node FROM l{0}),"
)
ORACLES["op6_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, substr(md5(coalesce(text, '')), 1, 16) AS tkey FROM documents),
s AS (SELECT source, count(*) AS n, sum(size) AS z FROM d GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM s),
w AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, 3 * z AS cap FROM r),
o AS (SELECT *, cap / w AS ratio, (sum(z) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level, row_number() OVER (ORDER BY cap / w, sid) AS pos FROM w
      WINDOW b AS (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT level FROM o WHERE level <= ratio ORDER BY pos LIMIT 1),
t AS (SELECT source, sid, CAST(z AS BIGINT) AS z, n, least(CAST(cap AS DOUBLE), (SELECT level FROM f) * w) AS target FROM o),
p AS (SELECT source, sid, z, target, CAST(round(target) AS BIGINT) AS quota, CASE WHEN z > 0 THEN CAST(round(target) AS BIGINT) // z ELSE 0 END AS whole, (n + 499) // 500 AS n_blocks FROM t),
k AS (SELECT d.doc_id, d.size, p.sid, p.z, p.target, p.whole, p.quota - p.whole * p.z AS rest, CAST('0x' || substr(md5('mix-1:doc:' || d.doc_id || ':' || d.size || ':' || d.tkey), 1, 15) AS BIGINT) AS key, n_blocks FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
b AS (SELECT *, key % n_blocks AS block FROM k),
bs AS (SELECT sid, block, sum(size) AS size FROM b GROUP BY 1, 2),
bo AS (SELECT sid, block, CAST(coalesce(sum(size) OVER (PARTITION BY sid ORDER BY CAST('0x' || substr(md5('mix-1:block:' || sid || ':' || block), 1, 15) AS BIGINT), block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM bs),
bi AS (SELECT b.*, CAST(coalesce(sum(b.size) OVER (PARTITION BY b.sid, b.block ORDER BY key, doc_id, b.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS inside FROM b),
c AS (SELECT bo.sid, bo.block, unnest(range(0, m.whole + CASE WHEN bo.before < m.rest THEN 1 ELSE 0 END)) AS epoch FROM bo JOIN (SELECT DISTINCT sid, whole, rest FROM b) m USING (sid)),
l0 AS (SELECT *, 0 AS node FROM c),
{levels}
x AS (SELECT bi.doc_id, bi.size, bi.z, bi.target, bi.whole, bi.sid, bi.block, greatest(0, least(bi.size, bi.rest - bo.before - bi.inside)) AS part FROM bi JOIN bo USING (sid, block)),
e AS (SELECT x.doc_id, x.size, x.z, x.target, x.whole, x.part, x.sid, x.block, string_agg(CAST(node AS VARCHAR), ',' ORDER BY epoch) FILTER (WHERE epoch < x.whole + CASE WHEN x.part > 0 THEN 1 ELSE 0 END) AS shards FROM x LEFT JOIN l4 USING (sid, block) GROUP BY ALL)
SELECT doc_id, size, z AS source_size, target, CAST(size * whole + part AS BIGINT) AS taken, CASE WHEN size > 0 THEN coalesce(shards, '') ELSE '' END AS shards FROM e
""".replace("{levels}", "\n".join(_LEVEL.format(k, k + 1) for k in range(4)))


@query
def op9_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op8_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), bw AS (
  SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM bw
), sized AS (
  SELECT DISTINCT m FROM windows
), dw AS (
  SELECT doc_id, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, sized WHERE len(w) >= m
), met AS (
  SELECT dw.doc_id, dw.i, dw.m, windows.item FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s FROM dw) dw JOIN windows ON windows.m = dw.m AND windows.s = dw.s
), words_hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM met) GROUP BY doc_id
), items_hit AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
"""


@query
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_secrets(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op5_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query
def op10_pii(spark, sf_dir):
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key=b"query op10")


@query
def op3_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, exactly; the query may miss a pair at the threshold with the chance that its recall leaves.
ORACLES["op3_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\S+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS grams FROM d),
c AS (SELECT grams, min(doc_id) AS rep, count(*) AS size FROM s WHERE len(grams) > 0 GROUP BY 1),
g AS (SELECT rep, unnest(grams) AS gram FROM c),
p AS (SELECT x.rep AS a, y.rep AS b, count(*) AS shared FROM g x JOIN g y ON x.gram = y.gram AND x.rep <> y.rep GROUP BY 1, 2),
l AS (SELECT a, b, cb.size FROM p JOIN c ca ON ca.rep = a JOIN c cb ON cb.rep = b WHERE shared >= 0.8 * (len(ca.grams) + len(cb.grams) - shared) - 1e-9),
n AS (SELECT a, sum(size) AS links FROM l GROUP BY 1),
r AS (SELECT rep AS a, rep AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT a, min(b) AS class_id FROM r GROUP BY 1)
SELECT s.doc_id, coalesce(m.class_id, s.doc_id) AS class_id, coalesce(c.rep, s.doc_id) AS copy_id, CAST(coalesce(c.size, 1) AS BIGINT) AS n_copies, CAST(coalesce(n.links, 0) + coalesce(c.size, 1) - 1 AS BIGINT) AS n_links
FROM s LEFT JOIN c ON c.grams = s.grams LEFT JOIN m ON m.a = c.rep LEFT JOIN n ON n.a = c.rep
"""


@query
def op2_line_dedup(spark, sf_dir):
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.repeats(table(spark, sf_dir, "documents"))


ORACLES["op1_suffix_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '\S+') AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
g AS (SELECT p.r, p.i, md5(array_to_string(d.w[p.i:p.i + 49], ' ')) AS h FROM p JOIN d USING (r)),
k AS (SELECT r, i FROM g SEMI JOIN (SELECT h FROM g GROUP BY 1 HAVING count(*) > 1) USING (h)),
b AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM k),
s AS (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS span FROM b)
SELECT doc_id, CAST(min(i) - 1 AS INTEGER) AS start_word, CAST(max(i) + 49 AS INTEGER) AS end_word, CAST(max(i) - min(i) + 50 AS INTEGER) AS n_words FROM s JOIN d USING (r) GROUP BY doc_id, r, span
"""


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
