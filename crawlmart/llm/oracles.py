"""The registered queries that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

from crawlmart.llm import chat, quality, secrets

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT r, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
  END AS s FROM w
), t AS (SELECT r, len(s) AS n, unnest(s) AS x FROM s),
shared AS (
  SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM t a JOIN t b ON a.x = b.x AND a.r <> b.r GROUP BY a.r, b.r
), linked AS (SELECT a, b FROM shared WHERE 100 * k >= 75 * (na + nb - k)),
reached AS (SELECT r AS a, r AS b FROM s UNION SELECT reached.a, linked.b FROM reached
            JOIN linked ON reached.b = linked.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM s JOIN reached ON reached.a = s.r JOIN s o ON o.r = reached.b
GROUP BY s.r, s.doc_id, len(s.s)
"""

NEAREST = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def _secret_scan() -> str:
    # No lookaround here: a secret is the part of a run with dots that lies before the first.
    run, secret = "[A-Za-z0-9+/_.-]+={0,2}", "^[A-Za-z0-9+/_-]{20,}={0,2}"
    parts, linked = [], []
    for rank, kind in enumerate(secrets.KINDS, 1):
        pattern = run if kind.name == "secret" else kind.pattern
        quoted = pattern.replace("'", "''")
        ok = f"length(m[i]) >= {kind.least}"
        if kind.group:
            ok = f"length(regexp_extract(m[i], '{quoted}', 1)) >= {kind.least}"
        value = "m[i]"
        if kind.name == "secret":
            value = f"regexp_extract(m[i], '{secret}')"
            ok = f"NOT starts_with(m[i], '//') AND length({value}) >= {kind.least} AND " + " AND ".join(
                f"regexp_matches({value}, '{c}')" for c in ("[A-Z]", "[a-z]", "[0-9]")
            )
        parts.append(f"""
  SELECT r, {rank} AS rank, '{kind.name}' AS kind, p AS start, p + length({value}) AS stop FROM (
    SELECT r, i, m, list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS p
    FROM (SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
      SELECT r, regexp_extract_all(text, '{quoted}') AS m, string_split_regex(text, '{quoted}') AS g FROM d)))
  WHERE {ok}""")
        near = [
            f"EXISTS (SELECT 1 FROM s p WHERE p.r = s.r AND greatest(p.start, s.start) - least(p.stop, s.stop) <= {secrets.SCOPE} "
            f"AND p.kind IN ({', '.join(repr(k) for k in some)}))"
            for some in kind.needs
        ]
        linked.append(f"(kind = '{kind.name}'" + "".join(f" AND {x}" for x in near) + ")")
    counts = ", ".join(f"count(*) FILTER (kind = '{k}')::BIGINT AS n_{k}" for k in secrets.BASE)
    zeros = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)
    name = "kind || ':' || start || ':' || stop"
    order = "ORDER BY start, rank, stop"
    base = f"FILTER (rank <= {len(secrets.BASE)})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(parts)}
), k AS (SELECT * FROM s WHERE {" OR ".join(linked)}),
a AS (SELECT r, {counts}, string_agg({name}, ',' {order}) {base} AS base,
             string_agg({name}, ',' {order}) AS spans FROM k GROUP BY r)
SELECT doc_id, {zeros}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (r)
"""


def _line_quality(rules: quality.Rules = quality.Rules()) -> str:
    phrases = " OR ".join(f"contains(lower(line), '{p}')" for p in rules.boilerplate)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), win AS (
  SELECT r, unnest(range(1, len(w) - 3)) AS i, unnest([array_to_string(w[j:j + 4], ' ')
         FOR j IN range(1, len(w) - 3)]) AS x FROM d WHERE len(w) >= 5
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM win) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k)::BIGINT AS n FROM twice, range(5) AS g(k) GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), measured AS (
  SELECT r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w,
         len(regexp_extract_all(line, '{quality.ITEMS}')) AS items,
         len(regexp_extract_all(line, '{quality.SYMBOLS}')) AS symbols,
         len(regexp_extract_all(line, '\p{{Lu}}')) AS capitals
  FROM lines
), judged AS (
  SELECT r, len(w) AS n, len(w) > 0 AND (
    (items >= {rules.menu_items} AND len(w) <= {rules.menu_words} * (items + 1))
    OR symbols > {rules.max_symbols} * len(w)
    OR (len(w) >= {rules.min_line} AND (
      capitals > {rules.max_shout} * length(line)
      OR (len(list_distinct(w)) < {rules.min_distinct} * len(w)
          AND len([i FOR i IN range(2, len(w) + 1) IF w[i] = w[i - 1]]) > {rules.max_stutter} * len(w))))
    OR (len(w) <= {rules.boilerplate_words} AND ({phrases}))
  ) AS failed, line
  FROM measured
), per_doc AS (
  SELECT r, coalesce(sum(n) FILTER (WHERE failed), 0)::BIGINT AS lost,
         (count(*) FILTER (WHERE n > 0) - count(DISTINCT line) FILTER (WHERE n > 0))::BIGINT AS dup
  FROM judged GROUP BY r
), out AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '{quality.SYMBOLS}'))::BIGINT AS n_symbols,
         dup AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, lost AS lost_words
  FROM d JOIN per_doc USING (r) LEFT JOIN covered USING (r)
)
SELECT *, (n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat} * n_words) AS base_failed,
  n_words >= {rules.min_words} AND 100 * n_repeat_words <= {rules.max_repeat} * n_words
    AND lost_words <= {rules.max_lost} * n_words AS kept
FROM out
"""


def _chat_format(template: chat.Template = chat.INSTRUCT) -> str:
    tails = "|".join(t.replace("]", "\\]") for t in sorted({c[1:] for c in template.control}))
    marked = r"len(regexp_extract_all({}, '[\[<]\\*(" + tails + ")'))"
    frame = " ".join(
        f"WHEN '{role}' THEN {len(t.open) + len(t.close)}" for role, t in template.turns.items()
    )
    other = len(template.other.open) + len(template.other_text) + len(template.other.close)
    loss = ", ".join(f"'{role}'" for role, t in template.turns.items() if t.loss)
    moves = " OR ".join(
        f"(role = '{role}' AND before = '{state}')"
        for state, roles in template.follows.items()
        for role in roles
    )
    accepts = ", ".join(f"'{x}'" for x in template.accepts)
    said = "</s>[INST] ok [/INST]"
    return rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{said}'), (-7, 1, 'assistant', '{said}')
), o AS (
  SELECT *, row_number() OVER w AS i, coalesce(lag(role) OVER w, 'start') AS before,
    length(text) + {marked.format("text")} + CASE role {frame}
      ELSE {other} + length(role) + {marked.format("role")} END AS size
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
), g AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS told,
    coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role IN ({loss})), '') AS loss,
    sum(size)::BIGINT AS formatted_chars, bool_and({moves}) AS valid,
    arg_max(role, i) IN ({accepts}) AS ended
  FROM o GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars, valid, valid AND ended AS complete
FROM g
"""


ORACLES = {
    "op3_jaccard_join": JACCARD,
    "op4_secret_scan": _secret_scan(),
    "op5_nearest_vectors": NEAREST,
    "op7_line_quality": _line_quality(),
    "op10_chat_format": _chat_format(),
}
