"""Queries of this package by name, and SQL for the same results where SQL can express them."""

from functools import wraps

from pyspark.sql import functions as F

from heatline.llm import (
    langid, lexical, licences, mixing, neighbours, pieces, pii, quality, repeats, rules, simhash, whitening, winnowing)
from heatline.llm.common import read

QUERIES = {}
SQL = {}


def query(function):
    @wraps(function)
    def run(spark, folder):
        return function(spark, folder)
    QUERIES[function.__name__] = run
    return run


@query
def op5_simhash(spark, folder):
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query
def op3_language(spark, folder):
    return langid.identify(read(spark, folder, "documents"))


@query
def op9_quality(spark, folder):
    return quality.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op8_rules(spark, folder):
    return rules.judge(read(spark, folder, "documents"))


@query
def op6_pii(spark, folder):
    return pii.report(read(spark, folder, "documents"))


@query
def op1_mixing(spark, folder):
    return mixing.mix(read(spark, folder, "documents"))


SQL["op1_mixing"] = r"""
WITH RECURSIVE
rows_ AS (SELECT doc_id, coalesce(source, '') AS src,
                 greatest(1, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0))::BIGINT AS tokens
          FROM documents),
totals AS (SELECT src, sum(tokens)::BIGINT AS t FROM rows_ GROUP BY src),
known AS (SELECT sum(t)::DOUBLE AS total, max(t)::DOUBLE AS most, min(t)::DOUBLE AS least, count(*) AS n FROM totals),
bisect AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 0.0::DOUBLE AS mid
  UNION ALL
  SELECT step + 1, CASE WHEN flat THEN mid ELSE low END, CASE WHEN flat THEN high ELSE mid END,
         CASE WHEN flat THEN (mid + high) / 2 ELSE (low + mid) / 2 END
  FROM (SELECT b.*, (SELECT ln(sum(pow(t / total, b.mid)))
                            - b.mid * sum(pow(t / total, b.mid) * ln(t / total)) / sum(pow(t / total, b.mid))
                            > 0.9995 * ln(any_value(n))
                            OR pow(any_value(most) / any_value(least), 1 - b.mid) > 2.0
                     FROM totals, known) AS flat
        FROM bisect b)
  WHERE step < 43),
alpha AS (SELECT high AS a FROM bisect WHERE step = 43),
plan AS (SELECT src, t, greatest(t, floor(t * pow(most / t, 1 - a) + 0.5)::BIGINT) AS budget FROM totals, known, alpha),
blocks AS (SELECT greatest(1, ceil(sum(budget)::DOUBLE / 65536))::HUGEINT AS blocks FROM plan),
uses AS (SELECT doc_id, src, tokens, t, budget, epoch,
                ('0x' || substr(md5(concat_ws(':', 'use', epoch, doc_id, src, tokens)), 1, 15))::BIGINT AS axis,
                ('0x' || substr(md5(concat_ws(':', 'place', epoch, doc_id, src, tokens)), 1, 15))::BIGINT AS spot
         FROM rows_ JOIN plan USING (src), unnest(range(0, ceil(budget::DOUBLE / t)::BIGINT)) AS e(epoch)),
placed AS (SELECT *, epoch * t + coalesce(sum(tokens) OVER (PARTITION BY src, epoch ORDER BY axis, tokens
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM uses),
kept AS (SELECT *, ((before::HUGEINT * blocks) // budget)::BIGINT AS block FROM placed, blocks WHERE before < budget)
SELECT doc_id, src AS source, epoch::INTEGER AS epoch, block,
       (row_number() OVER (PARTITION BY block ORDER BY spot, epoch, doc_id) - 1)::INTEGER AS place, tokens
FROM kept
"""


@query
def op10_vectors(spark, folder):
    return neighbours.near_duplicates(read(spark, folder, "embeddings"))


@query
def op7_pieces(spark, folder):
    return pieces.encode(read(spark, folder, "documents").select("doc_id", "text")).drop("text")


@query
def op4_licenses(spark, folder):
    return licences.scan(read(spark, folder, "documents"))


@query
def op2_repeats(spark, folder):
    found = repeats.remove_repeats(read(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (sum, s) -> sum + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Every 50-byte string of every text, by its hexadecimal form.
SQL["op2_repeats"] = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
               FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM bytes, unnest(range(0, n - 49)) AS t(i) WHERE n >= 50),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, i FROM windows JOIN firsts USING (s) WHERE least < doc_id),
marked AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM gone),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY 1, 2),
gaps AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
               string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
        FROM gaps JOIN bytes USING (doc_id) GROUP BY 1)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
"""

# All pairs of a label. The query finds a pair at the threshold with a chance of 0.97, closer ones more surely.
SQL["op10_vectors"] = """
WITH RECURSIVE
usable AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
          WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT u AS node, u AS least FROM links UNION
          SELECT links.v, reach.least FROM reach JOIN links ON links.u = reach.node),
parts AS (SELECT node, min(least) AS least FROM reach GROUP BY 1),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY 1)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least, e.vec_id) AS component_id,
       coalesce(least, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counts ON u = e.vec_id LEFT JOIN parts ON node = e.vec_id
"""


@query
def op11_whitening(spark, folder):
    return whitening.whiten(read(spark, folder, "embeddings"))


@query
def op13_contamination(spark, folder):
    return winnowing.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


# Every span of ten words, by its words.
SQL["op13_contamination"] = r"""
WITH spoken AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (SELECT DISTINCT item, least(len(w), 10) AS m, w[i:i + least(len(w), 10) - 1] AS span
            FROM spoken, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0),
docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
spans AS (SELECT doc_id, m, i, w[i:i + m - 1] AS span FROM docs, (SELECT DISTINCT m FROM windows), unnest(range(1, len(w) - m + 2)) AS t(i)),
met AS (SELECT doc_id, spans.m, i, item FROM spans JOIN windows ON spans.m = windows.m AND spans.span = windows.span),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + m)) AS t(p) GROUP BY 1),
listed AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
           FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


@query
def op12_search(spark, folder):
    return lexical.search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


SQL["op12_search"] = r"""
WITH said AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
counts AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM said GROUP BY 1, 2),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counts GROUP BY 1),
known AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, known GROUP BY term, docs),
scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
           FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), known GROUP BY 1, 2),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10
"""
