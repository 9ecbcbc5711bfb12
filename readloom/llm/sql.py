"""DuckDB SQL that must give the rows of the queries beside it."""

from __future__ import annotations

from readloom.llm import licenses, quality

SEP = r"[\x20\x09-\x0D]+"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality_sql(documents: str = "documents") -> str:
    """The counts and the verdict of the line rules, with the cleaned text."""
    r = quality.LineRules()
    lower = "translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    furniture = quoted("|".join(quality.BOILERPLATE))
    line_end, inner_end = quoted(quality.LINE_END), quoted(quality.INNER_END)
    symbols = quoted(quality.SYMBOLS.strip("[]"))
    return f"""
WITH q_rows AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM {documents}),
q_words AS (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '{SEP}'), lambda x: x <> '') AS w FROM q_rows),
q_grams AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM q_words)),
q_twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM q_grams) WHERE n > 1),
q_repeat AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM q_twice) GROUP BY rid),
q_lines AS (
  SELECT rid, k, ls[k] AS l FROM (
    SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS k
    FROM (SELECT rid, string_split(t, chr(10)) AS ls FROM q_rows))),
q_passed AS (
  SELECT rid, k, l, regexp_matches(l, '{quality.HAS_WORD}') AS worded, NOT worded OR (
      (regexp_matches(right(l, {quality.LINE_TAIL}), {line_end}) OR (length(l) >= {r.long_line} AND regexp_matches(l, {inner_end})))
      AND length(l) - length(replace(l, '|', '')) < {r.navigation_marks}
      AND (length(l) - length(translate(l, {symbols}, ''))) * {r.chars_per_symbol} <= length(l)
      AND (length(l) - length(replace(l, '!', ''))) * {r.chars_per_shout} <= greatest(length(l), {r.chars_per_shout})
      AND NOT (length(l) <= {r.short_line} AND regexp_matches({lower}, {furniture}))) AS ok
  FROM q_lines),
q_lined AS (
  SELECT rid, count(*) FILTER (worded) - count(DISTINCT l) FILTER (worded) AS dup,
    coalesce(string_agg(l, chr(10) ORDER BY k) FILTER (ok), '') AS clean_text
  FROM q_passed GROUP BY rid),
q_all AS (
  SELECT q_words.rid, doc_id, len(w)::BIGINT AS n_words,
    list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars,
    (length(t) - length(translate(t, {symbols}, '')))::BIGINT AS n_symbols,
    dup::BIGINT AS n_dup_lines, coalesce(q_repeat.n, 0)::BIGINT AS n_repeat_words,
    length(clean_text)::BIGINT AS n_clean_chars, length(t) AS n_chars, clean_text
  FROM q_words JOIN q_lined USING (rid) LEFT JOIN q_repeat USING (rid)),
q_judged AS (
  SELECT *, n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed
  FROM q_all)
SELECT rid, doc_id, n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
  base_failed, NOT base_failed AND 100 * n_clean_chars >= {r.min_kept_percent} * n_chars AS kept,
  n_clean_chars, clean_text
FROM q_judged"""


def op6_sql() -> str:
    return f"SELECT * EXCLUDE (rid, clean_text) FROM ({quality_sql()})"


def op2_sql() -> str:
    known = licenses.known_sentences()
    values = ", ".join(f"({quoted(s)}, {quoted(i)})" for s, i in known.items())
    rest, found = "rest0", []
    steps = []
    for k, (licence, sequence) in enumerate(licenses.RULES):
        pattern = quoted(" " + "  ".join(sequence) + " ")
        steps.append(f"CASE WHEN contains({rest}, {pattern}) THEN {quoted(licence)} END AS f{k}")
        steps.append(f"replace({rest}, {pattern}, ' ~ ') AS rest{k + 1}")
        found.append(f"f{k}")
        rest = f"rest{k + 1}"
    columns = ", ".join(steps)
    order = " ".join(f"WHEN {quoted(name)} THEN {k}" for k, name in enumerate(dict.fromkeys(n for n, _ in licenses.RULES)))
    return f"""
WITH known(s, id) AS (VALUES {values}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
cut AS (
  SELECT rid, string_split(regexp_replace(
    translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{licenses.BOUNDARY}', chr(10), 'g'), chr(10)) AS ls FROM docs),
sentences AS (
  SELECT rid, k, trim(regexp_replace(ls[k], '[^a-z0-9]+', ' ', 'g')) AS s
  FROM (SELECT rid, ls, unnest(range(1, len(ls) + 1)) AS k FROM cut)),
ids AS (SELECT rid, count(*) AS n, string_agg(id, ',' ORDER BY k) AS joined,
    ' ' || string_agg(id || ' ', ' ' ORDER BY k) AS rest0
  FROM sentences JOIN known USING (s) GROUP BY rid),
matched AS (SELECT *, {columns} FROM ids),
named AS (SELECT rid, unnest([{', '.join(found)}]) AS name FROM matched),
listed AS (SELECT rid, string_agg(name, ',' ORDER BY CASE name {order} END) AS licenses
  FROM (SELECT DISTINCT rid, name FROM named WHERE name IS NOT NULL) GROUP BY rid)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(joined, '') AS sentence_ids,
  coalesce(licenses, '') AS licenses
FROM docs LEFT JOIN ids USING (rid) LEFT JOIN listed USING (rid)"""


def op12_sql() -> str:
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH items AS (SELECT row_number() OVER () AS item, item_id, {lower} AS t FROM benchmark),
docs AS (SELECT row_number() OVER () AS rid, doc_id, {lower} AS t FROM documents),
item_terms AS (
  SELECT item, term, count(*) AS times
  FROM (SELECT item, unnest(regexp_extract_all(t, '{term}')) AS term FROM items) GROUP BY item, term),
doc_terms AS (
  SELECT rid, term, count(*)::BIGINT AS tf
  FROM (SELECT rid, unnest(regexp_extract_all(t, '{term}')) AS term FROM docs) GROUP BY rid, term),
lengths AS (SELECT rid, sum(tf)::BIGINT AS n FROM doc_terms GROUP BY rid),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM doc_terms CROSS JOIN totals GROUP BY term),
damped AS (SELECT rid, 100 - 75 + ((75 * n * docs) // terms) AS m FROM lengths CROSS JOIN totals),
scored AS (
  SELECT item, rid, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM item_terms JOIN weights USING (term) JOIN doc_terms USING (term) JOIN damped USING (rid)
  GROUP BY item, rid),
ranked AS (
  SELECT item, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN docs USING (rid) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN items USING (item) WHERE rank <= 10"""
