"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from collections.abc import Sequence

from lakeward.llm import hard_negatives, mixing, topk, warc
from lakeward.llm.queries import FRACTION, LEVELS, WEIGHTS

BLANKS = "[\\x20\\x09-\\x0D]+"


def exact_dedup_sql() -> str:
    return f"""
WITH n AS (SELECT doc_id, sha256(coalesce(text, '')) AS raw_sha256, regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256, CAST(octet_length(encode(t)) AS BIGINT) AS n_bytes, raw_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


def line_windows_sql() -> str:
    bare = "trim(line, chr(32) || chr(9) || chr(13))"
    return f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
b AS (SELECT doc_id, i, {bare} AS line, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos FROM l WHERE {bare} <> ''),
w AS (SELECT doc_id, pos, line AS l1, lead(line, 1) OVER o AS l2, lead(line, 2) OVER o AS l3
      FROM b WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, pos) AS nth FROM w WHERE l3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM r, (VALUES (0), (1), (2)) AS v(k) WHERE nth > 1),
marked AS (SELECT l.doc_id, l.line, l.i, b.pos AS pos, gone.pos AS gone
           FROM l LEFT JOIN b ON l.doc_id = b.doc_id AND l.i = b.i
           LEFT JOIN gone ON gone.doc_id = b.doc_id AND gone.pos = b.pos),
out AS (SELECT doc_id, count(pos) AS n_lines, count(gone) AS n_removed,
               coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '') AS text
        FROM marked GROUP BY doc_id)
SELECT doc_id, n_lines, greatest(n_lines - 2, 0) AS n_windows, n_removed,
       CAST(length(text) AS BIGINT) AS n_chars_left, sha256(text) AS text_sha256
FROM out
"""


def topk_sql() -> str:
    return f"""
WITH f AS (SELECT vec_id, [CAST(floor({topk.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
           FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score
      FROM f AS q, f AS c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def mixing_sql(
    source: str = "documents", levels: Sequence[str] = LEVELS, fraction: float = FRACTION, weights=None,
    max_epochs: int = mixing.MAX_EPOCHS, seed: int = mixing.SEED, prefix: str = "",
) -> str:
    """CTEs, then doc_id, levels, tokens, budget and epochs of each row of ``source`` (which has no domain yet)."""
    weights = WEIGHTS if weights is None else weights

    def weight(level: str) -> str:
        return "CASE " + " ".join(f"WHEN {level} = '{v}' THEN {w}" for v, w in weights.get(level, {}).items()) + " ELSE 1 END" \
            if weights.get(level) else "1"

    p, out = prefix, []
    cols = ", ".join(levels)
    out.append(f"""{p}rows AS (SELECT doc_id, 'd' || CAST(ascii(right(source, 1)) % 3 AS VARCHAR) AS domain, lang, source,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM {source})""")
    out.append(f"{p}leaves AS (SELECT {cols}, CAST(sum(tokens) AS HUGEINT) AS tokens FROM {p}rows GROUP BY {cols})")
    above, given = "", f"(SELECT CAST(floor(sum(tokens) * CAST('{fraction}' AS DECIMAL(9, 6))) AS HUGEINT) AS given FROM {p}leaves)"
    for k, name in enumerate(levels):
        keys = ", ".join(levels[:k + 1])
        part = f"PARTITION BY {above}" if above else ""
        up = f"JOIN {p}b{k - 1} AS u ON " + " AND ".join(f"u.{c} IS NOT DISTINCT FROM s.{c}" for c in levels[:k]) if k else f", {given} AS u"
        out.append(f"""{p}s{k} AS (SELECT {keys}, CAST(sum(tokens) * {max_epochs} AS HUGEINT) AS supply,
            CAST(sum(tokens) AS HUGEINT) AS tokens, CAST({weight(name)} AS HUGEINT) AS weight FROM {p}leaves GROUP BY {keys})""")
        mine = ", ".join(f"s.{c}" for c in levels[:k + 1])
        out.append(f"{p}g{k} AS (SELECT {mine}, s.supply, s.tokens, s.weight, u.{'budget' if k else 'given'} AS given FROM {p}s{k} AS s {up})")
        out.append(f"""{p}o{k} AS (SELECT *, row_number() OVER o AS nth, coalesce(sum(supply) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
            AND 1 PRECEDING), 0)::HUGEINT AS used, (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS open
            FROM {p}g{k} WINDOW o AS ({part} ORDER BY CAST(supply AS DOUBLE) / CAST(weight AS DOUBLE), supply, {name}))""")
        # the first child whose share is smaller than its supply; shares from it on go by weight
        out.append(f"""{p}f{k} AS (SELECT *, min(CASE WHEN supply * open > greatest(given - used, 0) * weight THEN nth END)
            OVER ({part}) AS first FROM {p}o{k})""")
        out.append(f"""{p}l{k} AS (SELECT *, max(CASE WHEN nth = first THEN used END) OVER ({part}) AS level_used,
            max(CASE WHEN nth = first THEN open END) OVER ({part}) AS level_open FROM {p}f{k})""")
        out.append(f"""{p}b{k} AS (SELECT {keys}, tokens, CASE WHEN first IS NULL OR nth < first THEN supply
            ELSE least(supply, greatest(given - level_used, 0) * weight // level_open) END AS budget FROM {p}l{k})""")
        above = keys
    last = f"{p}b{len(levels) - 1}"
    same = " AND ".join(f"b.{c} IS NOT DISTINCT FROM r.{c}" for c in levels)
    out.append(f"""{p}placed AS (SELECT r.*, b.budget, CASE WHEN b.tokens > 0 THEN b.budget // b.tokens ELSE 0 END AS whole,
        CASE WHEN b.tokens > 0 THEN b.budget % b.tokens ELSE 0 END AS rest FROM {p}rows AS r JOIN {last} AS b ON {same})""")
    out.append(f"""{p}ends AS (SELECT *, sum(tokens) OVER (PARTITION BY {cols}
        ORDER BY md5('{seed}:' || CAST(whole AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR))) AS upto FROM {p}placed)""")
    out.append(f"""{p}mixed AS (SELECT doc_id, {cols}, tokens, CAST(budget AS BIGINT) AS budget,
        CAST(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS epochs FROM {p}ends)""")
    return ",\n".join(out)


def warc_sql() -> str:
    return f"""
WITH p AS (SELECT page_id, url, sha256(coalesce(html, '')) AS digest FROM pages),
v AS (SELECT page_id, url, digest, visit, (page_id + visit) % 5 AS kind, visit > 0 AND (page_id + visit) % 5 <> 0 AS revisit
      FROM p, (VALUES (0), (1), (2)) AS t(visit)),
u AS (SELECT page_id * 3 + visit AS record_id, visit * 86400 + page_id % 86400 AS secs, visit, kind, revisit, digest,
             regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z]+://', '') AS u FROM v),
c AS (SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(u, '^[^/?]*')), ':(80|443)$', ''), '^www\\.', '')
             || regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
      array_to_string(list_sort([x for x in string_split(regexp_extract(u, '\\?(.*)$', 1), '&')
             if x <> '' AND NOT regexp_matches(x, '{warc.TRACKING}')]), '&') AS args FROM u),
k AS (SELECT record_id, secs, visit, kind, revisit, digest, place || CASE WHEN args <> '' THEN '?' || args ELSE '' END AS url_key FROM c),
a AS (SELECT *, max(CASE WHEN NOT revisit THEN secs END) OVER (PARTITION BY url_key ORDER BY secs
             RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS src_at FROM k),
s AS (SELECT url_key, secs, max(record_id) AS src_id, arg_max(digest, record_id) AS src_digest, arg_max(visit, record_id) AS src_visit
      FROM k WHERE NOT revisit GROUP BY url_key, secs),
j AS (SELECT a.*, s.src_id, s.src_digest, s.src_visit,
             CASE WHEN NOT revisit THEN 'full' WHEN src_id IS NULL THEN 'no_earlier'
                  WHEN kind = 1 THEN CASE WHEN digest[1:16] = src_digest[1:16] THEN 'resolved' ELSE 'mismatch' END
                  WHEN kind = 2 THEN 'resolved' WHEN kind = 3 THEN 'mismatch' ELSE 'trusted' END AS outcome
      FROM a LEFT JOIN s ON s.url_key = a.url_key AND s.secs = a.src_at),
h AS (SELECT *, outcome IN ('resolved', 'trusted') AS taken FROM j)
SELECT record_id, url_key, outcome, CASE WHEN taken THEN src_id WHEN outcome = 'full' THEN record_id END AS source_id,
  CASE WHEN taken THEN src_digest WHEN outcome = 'full' THEN digest END AS payload_digest,
  CASE WHEN taken OR NOT revisit THEN 'content-length=1;content-type=text/html;date=visit ' || CAST(visit AS VARCHAR) || ';etag="'
            || CASE WHEN taken AND kind <> 1 THEN src_digest[1:16] ELSE digest[1:16] END || '";last-modified=Mon, 01 Jan 2024 00:00:00 GMT'
       ELSE 'content-length=0;' || CASE WHEN kind = 4 THEN 'content-type=text/plain;' ELSE '' END || 'date=visit ' || CAST(visit AS VARCHAR)
            || CASE WHEN kind = 1 THEN ';etag="' || digest[1:16] || '"' WHEN kind = 3 THEN ';etag="stale"'
                    WHEN kind = 2 THEN ';last-modified=Mon, 01 Jan 2024 00:00:00 GMT' ELSE '' END
  END AS headers
FROM h
"""


def secret_ledger_sql() -> str:
    """Places of all matches by the lengths of what lies between them; letters in either case are spelt out."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" for c in word)
    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    rules = {
        "assign": (f"({names})[\"\'\']?\\x20*[:=]\\x20*[\"\'\']?([A-Za-z0-9+/_.=-]+)", 2, 8),
        "access": ("AKIA[A-Z0-9]+", 0, 16), "hex": ("[0-9a-f]+", 0, 32)}
    out = ["WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)"]
    for kind, (pattern, group, least) in rules.items():
        out.append(f"""{kind} AS (
            SELECT r, s, s + length(m) AS e, '{kind}' AS kind FROM (
              SELECT r, ms[i] AS m, ps[i] AS p, CAST(coalesce(list_sum([length(x) for x in gs[1:i]]), 0)
                     + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) AS BIGINT) AS s
              FROM (SELECT r, gs, ms, ps, unnest(range(1, len(ms) + 1)) AS i FROM (
                SELECT r, regexp_split_to_array(t, '{pattern}') AS gs, regexp_extract_all(t, '{pattern}') AS ms,
                       regexp_extract_all(t, '{pattern}', {group}) AS ps FROM d)))
            WHERE length(p) >= {least})""")
    union = " UNION ALL ".join(f"SELECT *, {i} AS o FROM {kind}" for i, kind in enumerate(rules))
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in rules)
    out.append(f"""found AS (SELECT r, {counts}, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
        FROM ({union}) GROUP BY r)""")
    zero = ", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in rules)
    return ",\n".join(out) + f"""
SELECT doc_id, {zero}, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t) AS blob_sha256
FROM d LEFT JOIN found USING (r)"""


def hard_negatives_sql() -> str:
    low, high = hard_negatives.LOW, hard_negatives.HIGH
    return f"""
WITH f AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor({hard_negatives.SCALE} * CAST(x AS DOUBLE)) for x in embedding] AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
      FROM f AS a, f AS c WHERE a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES}),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS nth
      FROM p JOIN s USING (anchor_id)
      WHERE NOT s.same AND {low} * positive_score <= 100 * s.score AND 100 * s.score <= {high} * positive_score)
SELECT anchor_id, positive_id, CAST(nth AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE nth <= {hard_negatives.NEGATIVES}
"""


ORACLE: dict[str, str] = {
    "op1_exact_dedup": exact_dedup_sql(),
    "op2_warc_revisits": warc_sql(),
    "op7_line_windows": line_windows_sql(),
    "op8_exact_topk": topk_sql(),
    "op9_secret_ledger": secret_ledger_sql(),
    "op13_hard_negatives": hard_negatives_sql(),
    "op10_mixing": f"WITH {mixing_sql()}\nSELECT * FROM mixed",
}
