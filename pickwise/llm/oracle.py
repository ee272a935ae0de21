"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from pickwise.llm import quality as q

_SPACE = "[\\x09-\\x0D ]"


def _quality_sql() -> str:
    classes = ["upper", "digit", "punctuation", "symbol", "space", "rest"]
    commons = [f"common_{n}" for n in range(10)] + ["other"]
    lists = " ".join(
        f"WHEN '{lang}' THEN [{', '.join(repr(w) for w in words)}]"
        for lang, words in q.COMMON_WORDS.items()
    )
    count = lambda chars: f"length(regexp_replace(t, '[^{chars}]', '', 'g'))"
    common = ", ".join(
        f"len(list_filter(w, lambda x: x = common[{n + 1}])) AS common_{n}" for n in range(10)
    )
    langs = ", ".join(f"'{lang}'" for lang in q.COMMON_WORDS)

    def distance(columns):
        mine, theirs = (" + ".join(f"{p}.{c}" for c in columns) for p in ("c", "r"))
        terms = []
        for c in columns:
            a, b = f"(c.{c} / ({mine}))", f"(r.{c} / ({theirs}))"
            for x in (a, b):
                terms.append(f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({a} + {b})) ELSE 0 END")
        total = " + ".join(terms)
        return (
            f"coalesce(CASE WHEN ({mine}) > 0 AND ({theirs}) > 0 "
            f"THEN sqrt(greatest({total}, 0) / 2) ELSE 0 END, 0)"
        )

    sums = ", ".join(f"sum({c})::DOUBLE AS {c}" for c in classes + commons)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t,
         CASE lang {lists} END AS common
  FROM documents
), s AS (
  SELECT *, list_filter(string_split_regex(t, '{_SPACE}+'), lambda x: x <> '') AS w FROM d
), a AS (
  SELECT rid, doc_id, lang, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) AS n_chars, {count('\\p{Lu}')} AS upper,
         {count('0-9')} AS digit, {count(".,;:!?''\"()-")} AS punctuation,
         {count('#*$%&|<>')} AS symbol, {common},
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x09-\\x0D ]')) AS lines
  FROM s
), b AS (
  SELECT *, n_chars - word_chars AS space,
         n_chars - upper - digit - punctuation - symbol - (n_chars - word_chars) AS rest,
         n_words - ({' + '.join(f'common_{n}' for n in range(10))}) AS other,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM a
), keys AS (
  SELECT rid, list_transform(generate_series(1, n_words - 7), lambda p: array_to_string(w[p : p + 7], ' ')) AS k
  FROM b WHERE n_words > 8
), windows AS (
  SELECT rid, unnest(k) AS k, generate_subscripts(k, 1) AS p FROM keys
), repeated AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, k) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT p + o) AS n FROM repeated, (SELECT unnest(range(8)) AS o) GROUP BY rid
), ref AS (
  SELECT lang, {sums} FROM b WHERE lang IN ({langs}) AND n_words >= {q.MIN_WORDS} GROUP BY lang
), c AS (
  SELECT b.*, coalesce(covered.n, 0) AS n_repeat_words FROM b LEFT JOIN covered USING (rid)
), judged AS (
  SELECT c.*, {distance(classes)} AS class_distance, {distance(commons)} AS word_distance,
         c.n_words < {q.LEAST_WORDS} OR 100 * n_repeat_words > {q.MOST_REPEATED} * c.n_words AS base_failed
  FROM c LEFT JOIN ref r ON c.lang = r.lang
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       symbol::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed
         AND NOT (n_words >= {q.MIN_WORDS} AND class_distance > {q.MAX_CLASS_DISTANCE})
         AND NOT (n_words >= {q.MIN_WORDS_COMMON} AND word_distance > {q.MAX_WORD_DISTANCE}) AS kept
FROM judged
"""


_CHAT_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), n AS (
  SELECT floor(conv_id / 2)::BIGINT AS pair_id, conv_id % 2 = 0 AS chosen, conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS line,
         repeat('0', 13 + length(role))
           || repeat(CASE role WHEN 'assistant' THEN '1' ELSE '0' END, length(text) + 11) AS mask
  FROM t
), fork AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id,
         min(coalesce(a.pos, b.pos)) FILTER
           (a.pos IS NULL OR b.pos IS NULL OR a.role <> b.role OR a.text <> b.text) AS pos
  FROM (SELECT * FROM n WHERE chosen) a
  FULL JOIN (SELECT * FROM n WHERE NOT chosen) b ON a.pair_id = b.pair_id AND a.pos = b.pos
  GROUP BY 1
), p AS (
  SELECT n.*, coalesce(fork.pos, 1 + max(n.pos) OVER (PARTITION BY n.pair_id)) AS fork
  FROM n JOIN fork USING (pair_id)
)
SELECT pair_id, min(conv_id) FILTER (chosen) AS chosen_id, min(conv_id) FILTER (NOT chosen) AS rejected_id,
       min(fork) - 1 AS prefix_turns,
       coalesce(string_agg(line, '' ORDER BY pos) FILTER (chosen AND pos < fork), '') AS prompt,
       CASE WHEN count(*) FILTER (chosen) > 0 THEN
         coalesce(string_agg(line, '' ORDER BY pos) FILTER (chosen AND pos >= fork), '') END AS chosen,
       CASE WHEN count(*) FILTER (chosen) > 0 THEN
         coalesce(string_agg(mask, '' ORDER BY pos) FILTER (chosen AND pos >= fork), '') END AS chosen_mask,
       CASE WHEN count(*) FILTER (NOT chosen) > 0 THEN
         coalesce(string_agg(line, '' ORDER BY pos) FILTER (NOT chosen AND pos >= fork), '') END AS rejected,
       CASE WHEN count(*) FILTER (NOT chosen) > 0 THEN
         coalesce(string_agg(mask, '' ORDER BY pos) FILTER (NOT chosen AND pos >= fork), '') END AS rejected_mask
FROM p GROUP BY pair_id
"""


ORACLE_SQL = {"op2_chat": _CHAT_SQL, "op7_quality": _quality_sql()}
