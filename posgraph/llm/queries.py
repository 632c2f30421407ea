"""Registered queries of the operators: key -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from posgraph.llm import (conversations, decontaminate, divergence, exact, language, licenses, neardup, packing, pii, quality,
                          simhash, substrings, urls)
from posgraph.llm.common import table, tokenizer_path
from posgraph.llm.repair_sql import repair_sql


def op1_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op3_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir):
    return pii.scan(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_urls(spark, sf_dir):
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark), urls.train(urls.labelled_table(spark)))


def op7_substrings(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op8_packing(spark, sf_dir):
    return packing.best_fit(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_exact(spark, sf_dir):
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op10_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damage(rows), rows)


QUERIES = {f.__name__: f for f in (op1_near_duplicates, op2_language, op3_licenses, op4_pii, op5_decontaminate, op6_urls,
                                   op7_substrings, op8_packing, op9_exact, op10_quality, op11_source_divergence,
                                   op12_simhash, op13_conversations)}

ORACLE = {
    "op1_near_duplicates": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
            FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh
              FROM w),
        e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
              FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        l AS (SELECT a, b FROM p WHERE 100 * c >= 75 * (na + nb - c)),
        both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        reach(doc_id, x) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.doc_id, b.b FROM reach r JOIN both_ways b ON r.x = b.a),
        c AS (SELECT doc_id, min(x) AS component_id FROM reach GROUP BY doc_id)
        SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM s JOIN c USING (doc_id)""",
    "op3_licenses": rf"""
        WITH t(template, label, base, size, word, place, key) AS (VALUES {", ".join(map(str, licenses.template_rows()))}),
        d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
              FROM documents),
        w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
        h AS (SELECT * FROM w WHERE word IN (SELECT word FROM t)),
        c AS (SELECT word, count(DISTINCT r) AS df FROM h GROUP BY word),
        x AS (SELECT t.*, floor({licenses.UNIT} * ln(((SELECT count(*) FROM documents) + 1.0) / (coalesce(df, 0) + 1))) + 1 AS weight
              FROM t LEFT JOIN c USING (word)),
        total AS (SELECT template, sum(weight) AS total, sum(key) AS keys FROM x GROUP BY template),
        a AS (SELECT r, template, any_value(label) AS label, any_value(base) AS base, pos - place AS start,
                     sum(weight) AS found, sum(key) AS keys FROM h JOIN x USING (word) GROUP BY r, template, pos - place),
        g AS (SELECT a.*, found / total AS score FROM a JOIN total USING (template)
              WHERE a.keys = total.keys AND (base = 1 OR found / total >= {licenses.ACCEPT})),
        l AS (SELECT r, sum(base) AS n_base, min(CASE WHEN base = 1 THEN start END) AS first_word,
                     max(CASE WHEN base = 1 THEN start END) AS last_word, max(score) AS score,
                     string_agg(DISTINCT CASE WHEN base = 1 THEN label END, ',' ORDER BY CASE WHEN base = 1 THEN label END) AS base_labels,
                     string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM g GROUP BY r)
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
               CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
        FROM d LEFT JOIN l ON d.r = l.r""",
    "op7_substrings": r"""
        WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS x,
                     octet_length(encode(coalesce(text, ''))) AS n FROM documents),
        c AS (SELECT doc_id, n, x, unnest(range(0, n - 49, 500)) AS base FROM t WHERE n >= 50),
        p AS (SELECT doc_id, base, least(500, n - 49 - base) AS k, x[2 * base + 1:2 * (base + 549)] AS y FROM c),
        w AS (SELECT doc_id, base, unnest(range(0, k)) AS i, y FROM p),
        h AS (SELECT doc_id, base + i AS s, md5(y[2 * i + 1:2 * i + 100]) AS m FROM w),
        f AS (SELECT m, min(doc_id) AS lo FROM h GROUP BY m),
        r AS (SELECT doc_id, s FROM h JOIN f USING (m) WHERE doc_id > lo),
        g AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS fresh FROM r),
        k AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM g),
        spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 50 AS z FROM k GROUP BY 1, 2),
        v AS (SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS before FROM spans),
        y AS (SELECT t.doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS tail,
                     string_agg(x[2 * before + 1:2 * a], '' ORDER BY a) AS kept
              FROM v JOIN t ON v.doc_id = t.doc_id GROUP BY t.doc_id)
        SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
               sha256(CASE WHEN n_spans IS NULL THEN b ELSE unhex(kept || x[2 * tail + 1:]) END) AS kept_sha256
        FROM t LEFT JOIN y ON t.doc_id = y.doc_id""",
    "op9_exact": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
                   FROM documents),
             g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
        FROM t JOIN g USING (norm)""",
    "op11_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
        w AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
        t AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30),
        l AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS total FROM t GROUP BY lang),
        c AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM w SEMI JOIN t USING (lang, term) GROUP BY ALL),
        s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
        g AS (SELECT lang, source, coalesce(total, 0) AS total
              FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN s USING (lang, source)),
        p AS (SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
                     1 + 1000000000 * (coalesce(c.n, 0) + 5) // (g.total + 5 * l.v) AS p,
                     1 + 1000000000 * (t.n + 5) // (l.total + 5 * l.v) AS q
              FROM g JOIN t USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
                  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        own AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
        o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k
              FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INTEGER) AS rank
        FROM o WHERE part = 'pair' OR k <= 50""",
    "op13_conversations": repair_sql(),
}
