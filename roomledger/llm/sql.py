"""DuckDB SQL that gives the rows of the queries that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from roomledger.llm import licenses, quality, resample
from roomledger.llm.common import UPPER


def _texts(values: Sequence[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _term(p: str, q: str) -> str:
    part = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / (({p} + {q}) / 2)) ELSE 0 END"
    return f"({part(p)} + {part(q)})"


def quality_sql(limits: quality.Limits = quality.Limits()) -> str:
    count = lambda pattern: f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"
    marks = "[!\"''()+,./:;=?@\\[\\]^_`{}~-]"
    classes = ["wc - u - d - s - m", "u", "d", "s", "m", "length(t) - wc"]
    sums = ", ".join(f"CAST(sum({c}) AS DOUBLE) / sum(length(t)) AS q{i}" for i, c in enumerate(classes))
    class_terms = " + ".join(_term(f"(({c}) / CAST(length(t) AS DOUBLE))", f"q{i}") for i, c in enumerate(classes))
    return f"""
    WITH a AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
    b AS (SELECT *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM a),
    f AS (SELECT *, len(ws) AS n, length(array_to_string(ws, '')) AS wc, {count('\\p{Lu}')} AS u,
                 {count('[0-9]')} AS d, {count('[#*$%&|<>]')} AS s, {count(marks)} AS m,
                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
          FROM b),
    common AS (SELECT r, lang, word, count(*) AS k
               FROM (SELECT r, lang, lower(unnest(ws)) AS word FROM f)
               WHERE list_contains({_texts(quality.COMMON_WORDS)}, word) GROUP BY r, lang, word),
    ref AS (SELECT lang, sum(n) AS ref_n, {sums} FROM f GROUP BY lang HAVING sum(n) >= {limits.reference_words}),
    ref_words AS (SELECT c.lang, word, sum(k) / CAST(any_value(ref_n) AS DOUBLE) AS q
                  FROM common c JOIN ref ON c.lang IS NOT DISTINCT FROM ref.lang GROUP BY c.lang, word),
    all_q AS (SELECT lang, sum(q) AS q FROM ref_words GROUP BY lang),
    near AS (SELECT c.r, sum({_term('(k / CAST(n AS DOUBLE))', 'q')}) AS terms, sum(k) / any_value(CAST(n AS DOUBLE)) AS p, sum(q) AS q
             FROM common c JOIN f USING (r) JOIN ref_words w ON c.lang IS NOT DISTINCT FROM w.lang AND c.word = w.word
             GROUP BY c.r),
    win AS (SELECT r, i, array_to_string(ws[i : i + {limits.window - 1}], ' ') AS k
            FROM (SELECT r, ws, unnest(range(1, n - {limits.window - 2})) AS i FROM f WHERE n > {limits.window})),
    rep AS (SELECT r, i FROM (SELECT *, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
    cov AS (SELECT r, count(DISTINCT p) AS n_repeat
            FROM (SELECT r, i + unnest(range(0, {limits.window})) AS p FROM rep) GROUP BY r),
    z AS (SELECT f.*, coalesce(n_repeat, 0) AS n_repeat,
                 CASE WHEN ref_n IS NOT NULL AND length(t) >= {limits.class_chars}
                      THEN sqrt(greatest(({class_terms}) / 2, 0)) END AS class_distance,
                 CASE WHEN ref_n IS NOT NULL AND n >= {limits.word_words}
                      THEN sqrt(greatest((coalesce(terms, 0) + coalesce(all_q.q, 0) - coalesce(near.q, 0)
                           + {_term('(1 - coalesce(near.p, 0))', '(1 - coalesce(all_q.q, 0))')}) / 2, 0)) END AS word_distance
          FROM f LEFT JOIN cov USING (r) LEFT JOIN near USING (r)
          LEFT JOIN ref ON f.lang IS NOT DISTINCT FROM ref.lang
          LEFT JOIN all_q ON f.lang IS NOT DISTINCT FROM all_q.lang),
    y AS (SELECT *, n < {limits.least_words} OR 100 * n_repeat > {limits.repeat_percent} * n AS failed FROM z)
    SELECT doc_id, n AS n_words, wc AS word_chars, CAST(s AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(n_repeat AS BIGINT) AS n_repeat_words, failed AS base_failed,
           NOT failed AND coalesce(class_distance <= {limits.class_distance}, true)
           AND coalesce(word_distance <= {limits.word_distance}, true) AS kept
    FROM y
    """


def licenses_sql() -> str:
    between = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
    words = lambda x: f"list_filter(regexp_split_to_array({x}, '{between}'), lambda x: x <> '')"
    phrases = ", ".join(f"({_texts(p.split())}, '{label}')" for p, label in licenses.PHRASES)
    templates = ", ".join(f"('{t.label}', {_texts(t.words)}, {t.required})" for t in licenses.TEMPLATES)
    return f"""
    WITH a AS (SELECT row_number() OVER () AS r, doc_id, lower(coalesce(text, '')) AS t FROM documents),
    b AS (SELECT *, {words('t')} AS ws FROM a),
    phrases AS (FROM (VALUES {phrases}) AS p(ph, label)),
    templates AS (FROM (VALUES {templates}) AS p(label, tw, required)),
    places AS (SELECT r, i - 1 AS place, label
               FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM b WHERE t LIKE '%license%' OR t LIKE '%cc%'), phrases
               WHERE ws[i : i + len(ph) - 1] = ph),
    base AS (SELECT r, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY r),
    blocks AS (SELECT r, {words('block')} AS bw
               FROM (SELECT r, unnest(regexp_split_to_array(
                        regexp_replace(t, '([.!?:;])[ \\t\\r]*\\n', '\\1' || chr(10) || chr(10), 'g'), '\\n[ \\t\\r]*\\n\\s*')) AS block
                     FROM b)),
    found AS (SELECT r, label, len(list_intersect(tw, list_distinct(bw))) / CAST(len(tw) AS DOUBLE) AS share
              FROM blocks, templates WHERE len(list_intersect(tw, list_distinct(bw))) >= required),
    hits AS (SELECT r, max(share) AS share, list(DISTINCT label) AS labels FROM found GROUP BY r)
    SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(hits.labels, [])))), ','), '') AS labels,
           CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0) END::DOUBLE AS score
    FROM b LEFT JOIN base USING (r) LEFT JOIN hits USING (r)
    """


def resample_sql(draw: resample.Draw = resample.Draw()) -> str:
    """The checksum is computed byte by byte from its rule, once for each different feature."""
    words = (
        "list_filter(regexp_split_to_array(lower_ascii, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    )
    lower = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
    runs = " UNION ALL ".join(
        f"SELECT side, r, array_to_string(ws[i : i + {n}], ' ') AS feature FROM (SELECT side, r, ws, unnest(range(1, len(ws) - {n} + 1)) AS i FROM w)"
        for n in range(draw.run)
    )
    shifts = ", ".join(["0"] * 8)
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    return f"""
    WITH a AS (SELECT 0 AS side, row_number() OVER () AS r, doc_id, {lower} AS lower_ascii FROM documents
               UNION ALL SELECT 1, row_number() OVER (), NULL, {lower} FROM benchmark),
    w AS (SELECT side, r, doc_id, {words} AS ws FROM a),
    f AS ({runs}),
    t AS (SELECT list(list_reduce(list_prepend(b, [{shifts}]::BIGINT[]), lambda c, x: {step}) ORDER BY b) AS steps
          FROM range(256) AS g(b)),
    k AS (SELECT feature,
                 xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(feature))),
                       lambda p: CAST('0x' || substring(hex(encode(feature)), 2 * p + 1, 2) AS BIGINT))),
                     lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1])), 4294967295) % {draw.buckets} AS bucket
          FROM (SELECT DISTINCT feature FROM f), t),
    n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f JOIN k USING (feature) GROUP BY bucket),
    sums AS (SELECT coalesce(sum(s), 0) + {draw.buckets} AS ss, coalesce(sum(t), 0) + {draw.buckets} AS tt FROM n),
    gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(ss AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(tt AS DOUBLE)))) AS BIGINT) AS g
             FROM n, sums),
    own AS (SELECT r, count(*) AS n_features, CAST(floor(sum(g) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight
            FROM f JOIN k USING (feature) JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
    z AS (SELECT doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                 CAST('0x' || substring(sha256('{draw.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
          FROM w LEFT JOIN own USING (r) WHERE side = 0),
    y AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM z),
    x AS (SELECT *, n_words >= {draw.least_words} AS able,
                 row_number() OVER (PARTITION BY n_words >= {draw.least_words} ORDER BY score DESC, doc_id) AS place,
                 count(*) OVER (PARTITION BY n_words >= {draw.least_words}) AS n FROM y)
    SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {draw.percent} * n // 100 THEN place END AS rank FROM x
    """


TOPK_SQL = """
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
               FROM embeddings
               WHERE vec_id IS NOT NULL AND len(embedding) > 0
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.r, q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
          FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0),
    k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""

REPEATS_SQL = """
    WITH h AS (SELECT row_number() OVER () AS r, doc_id, octet_length(encode(coalesce(text, ''))) AS n,
                      hex(encode(coalesce(text, ''))) AS x FROM documents),
    w AS (SELECT r, i, md5_number(substring(x, 2 * i + 1, 400)) AS k
          FROM (SELECT r, x, unnest(range(0, n - 199)) AS i FROM h WHERE n >= 200)),
    rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
    run AS (SELECT r, i, sum(CASE WHEN i - before > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run
            FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM rep)),
    gone AS (SELECT r, run, min(i) AS s, max(i) + 200 AS e FROM run GROUP BY r, run),
    part AS (SELECT r, run, coalesce(lag(e) OVER (PARTITION BY r ORDER BY run), 0) AS a, s, e FROM gone),
    kept AS (SELECT h.r, string_agg(substring(x, 2 * a + 1, 2 * (s - a)), '' ORDER BY run) || any_value(substring(x, 2 * last + 1)) AS x,
                    sum(e - s) AS removed, count(*) AS spans
             FROM h JOIN part USING (r) JOIN (SELECT r, max(e) AS last FROM gone GROUP BY r) USING (r) GROUP BY h.r)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.x, h.x))) AS kept_sha256
    FROM h LEFT JOIN kept USING (r)
"""

SQL = {
    "op5_license_scan": licenses_sql(),
    "op7_topk_search": TOPK_SQL,
    "op9_quality_rules": quality_sql(),
    "op10_suffix_array_dedup": REPEATS_SQL,
    "op11_importance_resampling": resample_sql(),
}
