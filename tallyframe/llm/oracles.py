"""DuckDB equivalents of the queries that SQL can express: quality rules and chat formatting."""

from __future__ import annotations

from .rules import GRIDS, path

#: Rule values over the measures, as in ``rules.rule_values``.
VALUES = {
    "symbol_ratio": ("n_symbols", "n_words"),
    "shout_ratio": ("n_shouted", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
    "word_length": ("word_chars", "n_words"),
}
RISK, ERROR = 0.01, 0.05


def quality_rules() -> str:
    """Counts by windows over unnested words; cutoffs by the binomial distribution function, term by term with ``lgamma``."""
    rows = ", ".join(f"({j}, " + ", ".join(f"{step.get(r, 'NULL')}::DOUBLE" for r in GRIDS) + ")" for j, step in enumerate([{}, *path()]))
    fails = " OR ".join(f"coalesce(CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END > max_{r}, false)" for r, (a, b) in VALUES.items())
    return f"""
WITH numbered AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT row_id, doc_id, lang, text,
    list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM numbered
), word_rows AS (
  SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM split
), windowed AS (
  SELECT row_id, place, CASE WHEN lead(word, 4) OVER run IS NOT NULL THEN
    word || ' ' || lead(word, 1) OVER run || ' ' || lead(word, 2) OVER run || ' ' || lead(word, 3) OVER run || ' ' || lead(word, 4) OVER run END AS five
  FROM word_rows WINDOW run AS (PARTITION BY row_id ORDER BY place)
), twice AS (
  SELECT row_id, place, five IS NOT NULL AND count(*) OVER (PARTITION BY row_id, five) > 1 AS again FROM windowed
), covered AS (
  SELECT row_id, max(again::INT) OVER (PARTITION BY row_id ORDER BY place ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS inside FROM twice
), repeats AS (
  SELECT row_id, sum(inside) AS n FROM covered GROUP BY row_id
), counted AS (
  SELECT doc_id, lang, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
    len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x AND length(x) > 2))::BIGINT AS n_shouted,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeats r USING (row_id)
), measured AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
), trusted AS (
  SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), good AS (
  SELECT * FROM measured WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM trusted)
), steps(step, {", ".join(f"max_{r}" for r in GRIDS)}) AS (VALUES {rows}
), failing AS (
  SELECT lang, step, count(*) AS n, count(*) FILTER (WHERE {fails}) AS k FROM good, steps GROUP BY ALL
), tail AS (
  SELECT lang, step, step = 0 OR k <= n * {RISK!r} AND list_sum(list_transform(range(0, k + 1),
    lambda i: exp(lgamma(n + 1) - lgamma(greatest(i, 0) + 1) - lgamma(greatest(n - i, 0) + 1) + i * ln({RISK!r}) + (n - i) * ln(1 - {RISK!r}))))
    <= {ERROR!r} / (SELECT count(DISTINCT coalesce('x' || lang, '')) FROM good) AS allowed
  FROM failing
), taken AS (
  SELECT lang, coalesce(min(step) FILTER (WHERE NOT allowed) - 1, max(step)) AS step FROM tail GROUP BY lang
), limits AS (
  SELECT lang, steps.* EXCLUDE (step) FROM taken JOIN steps USING (step)
)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(f"coalesce(CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0.0 END <= max_{r}, true)" for r, (a, b) in VALUES.items())} AS kept
FROM measured m LEFT JOIN limits t ON m.lang IS NOT DISTINCT FROM t.lang
"""


#: The strings that the template escapes.
CONTROL = (
    "<|im_start|>", "<|im_end|>", "<|image|>", "<|audio|>", "<|document|>", "<|endoftext|>", "<|startoftext|>",
    "<s>", "</s>", "<SYS>>", "</SYS>>", "[INST]", "[/INST]",
)


def chat_digests() -> str:
    """The digests follow from the turns themselves; the formatted length counts one character per control string more."""
    mark = lambda s: s[0].replace("[", "\\[") + "\\\\*" + s[1:].replace("|", "\\|").replace("]", "\\]")
    control = "|".join(mark(s) for s in CONTROL)
    more = lambda c: f"length({c}) + len(regexp_extract_all({c}, '{control}'))"
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length('<|im_start|>') + {more("role")} + 1 + {more("text")} + length('<|im_end|>') + 1 AS formatted FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(formatted)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


def conversation_trie() -> str:
    """Nodes as lists of turns. CRC-32 bit by bit: each character's code, then eight steps."""
    codes = "flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END"
    crc = f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, e: {step}), 4294967295)"
    return f"""
WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (SELECT conv_id, turns, {crc} % 4 AS h FROM own),
rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns[:h], []), s.turns[h + 1:]) AS turns
  FROM shared s LEFT JOIN own b ON b.conv_id = s.conv_id - s.conv_id % 20
), numbered AS (  -- a number for each distinct turn keeps the paths short
  SELECT role, text, row_number() OVER () AS k, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT DISTINCT t.role AS role, t.text AS text FROM (SELECT unnest(turns) AS t FROM rebuilt))
), path AS (
  SELECT r.conv_id, coalesce(list(k ORDER BY d) FILTER (WHERE k IS NOT NULL), []) AS p, coalesce(list(words ORDER BY d) FILTER (WHERE k IS NOT NULL), []) AS w
  FROM rebuilt r LEFT JOIN (SELECT conv_id, unnest(turns) AS t, generate_subscripts(turns, 1) AS d FROM rebuilt) u ON u.conv_id = r.conv_id
  LEFT JOIN numbered n ON n.role = t.role AND n.text = t.text GROUP BY r.conv_id
), steps AS (
  SELECT conv_id, p[:d] AS node, d AS depth, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words, len(p) = d AS ends
  FROM (SELECT conv_id, p, w, unnest(range(len(p) + 1)) AS d FROM path)
), node AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(words) AS cost,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM steps GROUP BY node, depth
), below AS (
  SELECT p.node, p.depth, p.conv_id AS parent_conv_id, c.node AS child FROM node p JOIN node c ON c.depth = p.depth + 1 AND c.node[:p.depth] = p.node
), kids AS (SELECT node, count(*) AS n_children FROM below GROUP BY node),
subtree AS (
  SELECT node[:d] AS top, sum(cost) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves
  FROM (SELECT n.node, cost, k.node IS NULL AS leaf, unnest(range(n.depth + 1)) AS d FROM node n LEFT JOIN kids k ON k.node = n.node) GROUP BY top
)
SELECT n.conv_id, n.depth, b.parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN subtree s ON s.top = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN below b ON b.child = n.node
"""


def source_divergence(least_docs: int = 3, top: int = 200) -> str:
    """Every kept term for every group, whether it occurs there or not."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    share = "CAST(1 + CAST(1000000000 AS HUGEINT) * (n + 1) // (sum(n) OVER (PARTITION BY {}) + count(*) OVER (PARTITION BY {})) AS BIGINT)"
    f = "CAST(CAST(g.p - {0} AS HUGEINT) * (g.p - {0}) // {0} AS BIGINT)"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({low}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), found AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT d) >= {least_docs}),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM found GROUP BY ALL),
laid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM groups g JOIN kept k ON k.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), g AS MATERIALIZED (SELECT *, {share.format("lang, source", "lang, source")} AS p FROM laid),
l AS (SELECT lang, term, {share.format("lang", "lang")} AS q FROM kept),
pairs AS (
  SELECT g.lang, g.source, o.source AS item, CAST(sum({f.format("o.p")}) AS BIGINT) AS value
  FROM g JOIN g o ON o.lang = g.lang AND o.term = g.term AND o.source <> g.source GROUP BY ALL
), pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), term AS (SELECT g.lang, g.source, g.term AS item, {f.format("q")} AS value FROM g JOIN l ON l.lang = g.lang AND l.term = g.term WHERE n > 0 AND g.p > q),
both_parts AS (SELECT *, 'pair' AS part FROM pair UNION ALL SELECT *, 'term' FROM term),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM both_parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""


ORACLES = {"op3_rules": quality_rules(), "op10_chat": chat_digests(), "op11_trie": conversation_trie(), "op12_divergence": source_divergence()}
