"""DuckDB SQL of the operators that SQL can express, written from the task's definitions."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_OP6 = r"""
WITH split AS (
  SELECT page_id, lower_host AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM (
    SELECT page_id, rest, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_host FROM (
      SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages))),
rules(text, h, p, v) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
ruled AS (
  SELECT s.*, (SELECT arg_max(text, length(text)) FROM rules WHERE (s.host = h OR suffix(s.host, '.' || h)) AND prefix(s.path, p)) AS rule FROM split s),
judged AS (SELECT r.*, v AS given FROM ruled r LEFT JOIN rules ON text = rule),
hosts AS (
  SELECT host, count(given) AS n, coalesce(sum((given = 'block')::INT), 0) AS b,
    array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix FROM judged GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM domains GROUP BY ALL),
corpus AS (SELECT (coalesce(sum(b), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM suffixes),
levels AS (SELECT 'h' AS lv, n, b FROM hosts UNION ALL SELECT 'd', n, b FROM domains UNION ALL SELECT 's', n, b FROM suffixes),
moments AS (SELECT lv, sum(n) AS n, sum(b) AS b, count(*) AS g, sum(n * n) AS nn, sum(b * b / n) AS bbn FROM levels WHERE n > 0 GROUP BY lv),
strength AS (SELECT lv, 1 / greatest(0.001, least(0.999, CASE WHEN b > 0 AND b < n AND n - nn / n - (g - 1) > 0
  THEN ((bbn - b * (b / n)) / ((b / n) * (1 - b / n)) - (g - 1)) / (n - nn / n - (g - 1)) ELSE 0.5 END)) - 1 AS k FROM moments),
ks AS (SELECT coalesce(max(k) FILTER (lv = 'h'), 1) AS kh, coalesce(max(k) FILTER (lv = 'd'), 1) AS kd, coalesce(max(k) FILTER (lv = 's'), 1) AS ksx FROM strength),
ms AS (SELECT suffix, (b + ksx * m) / (n + ksx) AS ms FROM suffixes, corpus, ks),
md AS (SELECT domain, (b + kd * ms) / (n + kd) AS md FROM domains JOIN ms USING (suffix), ks),
post AS (SELECT host, b + kh * md AS alpha, n - b + kh * (1 - md) AS beta FROM hosts JOIN md USING (domain), ks),
bad AS (SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (alpha + beta + 1)) > 0.5 AS bad FROM (SELECT *, alpha / (alpha + beta) AS mean FROM post))
SELECT page_id, j.host, path, rule, coalesce(given, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN bad USING (host)
"""


def _op8() -> str:
    # name, count, base, upper quantile, spreads, slack, whether too low a rate fails as well
    rates = (("word_length", "word_chars", "n_words", 90, 4.0, 0, True), ("symbol_rate", "n_symbols", "n_words", 90, 4.0, 3, False),
             ("dup_lines", "n_dup_lines", "n_lines", 98, 0.5, 1, False), ("repeat_rate", "n_repeat_words", "n_words", 98, 0.5, 6, False))
    each = " UNION ALL ".join(f"SELECT rid, lang, source, '{r}' AS rate, {c} AS c, {b} AS base, {u} AS u, {k}::DOUBLE AS k, {slack} AS slack, {str(below).lower()} AS below "
                              f"FROM stats WHERE NOT base_failed" for r, c, b, u, k, slack, below in rates)
    picks = ", ".join(f"min(CASE WHEN upto * 100 >= n_rows * {k} THEN value END) AS {n}" for n, k in (("low", "(100 - u)"), ("mid", "50"), ("high", "u")))

    def quantiles(keys: str) -> str:
        by = f"{keys}, rate" if keys else "rate"
        return (f"SELECT {by}, max(n_rows) AS n_rows, {picks} FROM (SELECT {by}, u, CASE WHEN bucket = -100000 THEN 0 ELSE pow(1.02, bucket - 0.5) END AS value, "
                f"sum(n) OVER (PARTITION BY {by}) AS n_rows, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto "
                f"FROM (SELECT {by}, u, bucket, sum(n) AS n FROM sketch GROUP BY ALL)) GROUP BY {by}")

    def blended(own: str, up: str, on: str, keys: str) -> str:
        mixed = ", ".join(f"(o.n_rows * o.{q} + 200 * p.{q}) / (o.n_rows + 200) AS {q}" for q in ("low", "mid", "high"))
        return f"SELECT {keys}, o.rate, {mixed} FROM {own} o JOIN {up} p ON o.rate = p.rate{on}"

    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '{_WORD}') AS w FROM docs),
windows AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
found AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM found, (VALUES (0), (1), (2)) AS o(k) GROUP BY rid),
stats AS (
  SELECT rid, doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed FROM (
    SELECT rid, doc_id, lang, source, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
      len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines
    FROM (SELECT *, [x for x in string_split(t, chr(10)) if regexp_matches(x, '{_WORD}')] AS lines FROM words)) LEFT JOIN covered USING (rid)),
rates AS ({each}),
sketch AS (SELECT lang, source, rate, u, CASE WHEN c <= 0 THEN -100000 ELSE ceil(ln(c / base) / ln(1.02))::INT END AS bucket, count(*) AS n FROM rates GROUP BY ALL),
own AS ({quantiles("lang, source")}), by_lang AS ({quantiles("lang")}), overall AS ({quantiles("")}),
lang_cut AS ({blended("by_lang", "overall", "", "o.lang")}),
cuts AS ({blended("own", "lang_cut", " AND o.lang IS NOT DISTINCT FROM p.lang", "o.lang, o.source")}),
verdicts AS (
  SELECT r.rid, bool_or(c > (high + k * greatest(high - mid, 0.02 * mid)) * base + slack OR (below AND c < (low - k * greatest(mid - low, 0.02 * mid)) * base - slack)) AS fails
  FROM rates r JOIN cuts o ON o.lang IS NOT DISTINCT FROM r.lang AND o.source IS NOT DISTINCT FROM r.source AND o.rate = r.rate GROUP BY r.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(fails, false) AS kept
FROM stats LEFT JOIN verdicts USING (rid)
"""


_OP11 = r"""
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
drawn AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS tokens, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
  ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM hashed),
units AS (SELECT *, len(tokens) AS n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle, array_to_string(tokens[b + 1:n], '') AS suffix FROM units)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

_OP13 = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT rid, doc_id, len(terms) AS n, terms FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sized),
tfs AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL),
dfs AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total),
wanted AS (SELECT item_id, term, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
scores AS (SELECT item_id, rid, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM wanted JOIN dfs USING (term) JOIN tfs USING (term), total GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scores WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

SQL = {"op6_url_filters": _OP6, "op8_quality_rules": _op8(), "op11_fill_middle": _OP11, "op13_lexical_search": _OP13}
