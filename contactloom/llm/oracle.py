"""SQL twins of the text operators that DuckDB's SQL can express."""

from __future__ import annotations

from contactloom.llm import quality_rules

_L = quality_rules.PIPELINE
_N = _L.n_common
_WORDS = "[{}]".format(", ".join(f"'{w}'" for w in quality_rules.EVERY))
_COUNT = lambda cls: f"length(regexp_replace(t, '[^{cls}]', '', 'g'))"
_TERM = lambda x, y: f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({x} + {y})) ELSE 0 END"


def _distance(p: str, q: str, n: int) -> str:
    terms = " + ".join(f"{_TERM(f'{p}[{i}]', f'{q}[{i}]')} + {_TERM(f'{q}[{i}]', f'{p}[{i}]')}" for i in range(1, n + 1))
    return f"round(sqrt(greatest(({terms}) / 2, 0.0)), 6)"


QUALITY = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, CASE WHEN lang IN ('de', 'en', 'es', 'fr') THEN lang ELSE '_other' END AS lang FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws, length(t) AS n FROM d),
x AS (SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS c FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM x WHERE c > 1) GROUP BY r),
ln AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
f AS (SELECT w.r, doc_id, lang, n, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, {_COUNT('#*$%&|<>')} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  {_COUNT('a-z')} AS lo, {_COUNT('A-Z')} AS up, {_COUNT('0-9')} AS dg, {_COUNT('\\x20\\x09-\\x0D')} AS sp, {_COUNT('\\x00-\\x7F')} AS ascii_, list_transform({_WORDS}, lambda c: len(list_filter(ws, lambda y: y = c))) AS hits
  FROM w LEFT JOIN rep ON w.r = rep.r LEFT JOIN ln ON w.r = ln.r),
s AS (SELECT *, list_transform([lo, sp, up, n_symbols, dg, ascii_ - lo - sp - up - n_symbols - dg, n - ascii_], lambda v: v / greatest(n, 1)) AS cs,
  list_transform(list_append(hits, n_words - coalesce(list_sum(hits), 0)), lambda v: v / greatest(n_words, 1)) AS wd FROM f),
ref AS (SELECT lang AS k, {", ".join(f"round(avg(cs[{i}]) FILTER (n >= {_L.judge_chars}), 9) AS c{i}" for i in range(1, 8))}, {", ".join(f"round(avg(wd[{i}]) FILTER (n_words >= {_L.judge_words}), 9) AS w{i}" for i in range(1, _N + 2))}
  FROM s WHERE n >= {_L.judge_chars} OR n_words >= {_L.judge_words} GROUP BY 1),
g AS (SELECT s.*, [{", ".join(f"c{i}" for i in range(1, 8))}] AS rc, [{", ".join(f"w{i}" for i in range(1, _N + 2))}] AS rw, [{", ".join(["0.0::double"] * _N)}, 1.0::double] AS bare,
  n_words < {_L.min_words} OR 100 * n_repeat_words > {_L.repeat_percent} * n_words AS base_failed FROM s LEFT JOIN ref ON s.lang = ref.k),
h AS (SELECT *, CASE WHEN n >= {_L.judge_chars} THEN {_distance("cs", "rc", 7)} END AS char_distance, CASE WHEN n_words >= {_L.judge_words} AND lang <> '_other' THEN {_distance("wd", "rw", _N + 1)} END AS word_distance,
  {_distance("bare", "rw", _N + 1)} AS bare_distance FROM g)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(char_distance, 0) <= {_L.max_char_distance} AND coalesce(word_distance, 0) <= coalesce(CASE WHEN bare_distance > 0 THEN {_L.word_reach} * bare_distance ELSE 1.0 END, 1.0) AS kept, char_distance, word_distance FROM h"""

ORACLE = {"op5_quality_rules": QUALITY}
