"""DuckDB SQL for the rows of the queries that SQL can express."""

OP8 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

OP3 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s),
-- The excess of capped sources is reshared by weight until none is above its cap.
r AS (
  SELECT source, source_size, weight, false AS capped, 0 AS round FROM w
  UNION ALL
  SELECT source, source_size, weight,
         capped OR CAST(sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER () AS DOUBLE)
                   / (sum(weight) OVER () - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ()) * weight > 3 * source_size,
         round + 1
  FROM r WHERE round < (SELECT count(*) FROM s)),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
              ELSE CAST(sum(source_size) OVER () - sum(CASE WHEN capped THEN 3 * source_size ELSE 0 END) OVER () AS DOUBLE)
                   / (sum(weight) OVER () - sum(CASE WHEN capped THEN weight ELSE 0 END) OVER ()) * weight END AS target
  FROM r WHERE round = (SELECT count(*) FROM s)),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
c AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS inside
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND (upto < rest OR (upto - inside < rest AND upto - rest <= rest - (upto - inside))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""


OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS k FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
x AS (SELECT k, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS s FROM w WHERE len(w) >= 8),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, s) AS n FROM x) WHERE n > 1),
covered AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY k),
l AS (SELECT k, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN l USING (k) LEFT JOIN covered USING (k)),
b AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (word_chars < 2 * n_words)::INT + 8 * (word_chars > 14 * n_words)::INT
  + 16 * (10 * n_symbols > 6 * n_words)::INT + 32 * (n_dup_lines >= 3 AND 8 * n_dup_lines > n_words)::INT AS BIGINT) AS fail_bits FROM m)
SELECT *, 1 AS rules_version, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, 'v1' AS policy FROM b
"""
ABLATION = f"""
SELECT rule, count(*) FILTER (fail_bits & bit <> 0) AS fails, count(*) FILTER (fail_bits = bit) AS fails_alone
FROM ({OP6}), (VALUES ('too_few_words', 1), ('repeated_windows', 2), ('short_words', 4), ('long_words', 8), ('symbols', 16), ('duplicate_lines', 32)) r(rule, bit) GROUP BY rule
"""


def _op1() -> str:
    from .license_scan import TEMPLATES

    rows = ", ".join("('" + "', '".join(x.replace("'", "''") for x in item) + "')" for item in TEMPLATES.items())
    shingles = "list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"
    tokens = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return f"""
WITH t AS (SELECT license, {shingles} AS s FROM (SELECT license, {tokens.format('text')} AS w FROM (VALUES {rows}) v(license, text))),
d AS (SELECT doc_id, {shingles} AS s FROM (SELECT doc_id, {tokens.format('text')} AS w FROM documents WHERE text IS NOT NULL) WHERE len(w) >= 5),
m AS (SELECT doc_id, license, CAST(len(list_intersect(d.s, t.s)) AS BIGINT) AS n_found, len(t.s) AS n FROM d, t)
SELECT doc_id, license, n_found, CAST(n_found AS DOUBLE) / n AS containment FROM m WHERE CAST(n_found AS DOUBLE) / n >= 0.8
"""


def _op7() -> str:
    """Spans by windows over unnested matches; entropy of every window by the library's own aggregate."""
    from .secrets import ALLOWED, CLASSES, FILLERS

    either = lambda words: "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words) + ")"
    keys = either(("password", "passwd", "secret", "token", "api_?key"))
    value = r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    masked = "t"
    for n in sorted({len(f) for f in FILLERS}, reverse=True):
        masked = f"regexp_replace({masked}, '{either([f for f in FILLERS if len(f) == n])}', '{' ' * n}', 'g')"
    kinds = [("assign", f"{keys}{value}", "t", f"length(regexp_extract(hit, '{keys}{value}', 2)) >= 12"), ("access", "AKIA[A-Z0-9]+", "t", "length(hit) >= 18"), ("hex", "[0-9a-f]+", "t", "length(hit) >= 16")]
    kinds += [(c.kind, c.pattern, "m", f"NOT regexp_matches(hit, '{ALLOWED}')") for c in CLASSES]
    found = " UNION ALL ".join(
        f"""SELECT k, '{kind}' AS kind, {rank} AS rank, before + len_part AS start_, before + len_part + length(hit) AS end_, hit FROM (
          SELECT k, hit, length(part) AS len_part, coalesce(sum(length(part) + length(hit)) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
            SELECT k, unnest(hits) AS hit, unnest(parts[:len(hits)]) AS part, unnest(range(len(hits))) AS i FROM (
              SELECT k, regexp_extract_all({of}, '{pattern}') AS hits, regexp_split_to_array({of}, '{pattern}') AS parts FROM d WHERE regexp_matches({of}, '{pattern}')))) WHERE {fits}"""
        for rank, (kind, pattern, of, fits) in enumerate(kinds)
    )
    window = "CASE kind " + " ".join(f"WHEN '{c.kind}' THEN {c.window}" for c in CLASSES) + " END"
    least = "CASE kind " + " ".join(f"WHEN '{c.kind}' THEN {c.threshold}" for c in CLASSES) + " END"
    return f"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents), d AS (SELECT k, doc_id, t, {masked} AS m FROM t),
found AS ({found}),
windows AS (SELECT k, kind, rank, start_, i, list_aggregate(string_split(substr(hit, CAST(i + 1 AS BIGINT), w), ''), 'entropy') >= {least} AS hot, w
  FROM (SELECT *, {window} AS w, unnest(range(length(hit) - {window} + 1)) AS i FROM found WHERE rank >= 3)),
spans AS (SELECT k, kind, rank, start_, end_ FROM found WHERE rank < 3
  UNION ALL SELECT k, kind, rank, start_ + min(i), start_ + max(i) + any_value(w) FROM windows WHERE hot GROUP BY k, kind, rank, start_),
line AS (SELECT k, rank, start_, end_, concat_ws(':', kind, CAST(start_ AS BIGINT), CAST(end_ AS BIGINT)) AS s FROM spans)
SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  sha256(coalesce(string_agg(s, ',' ORDER BY start_, rank, end_) FILTER (rank < 3), '')) AS base_sha256, coalesce(string_agg(s, ',' ORDER BY start_, rank, end_), '') AS spans
FROM d LEFT JOIN line USING (k) GROUP BY k, doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": _op1(), "op3_mix_sources": OP3, "op6_quality_ledger": OP6, "op7_secret_scan": _op7(), "op8_exact_dedup": OP8, "quality_ablation": ABLATION}
