"""DuckDB SQL of those queries that SQL can express. The others are tested against brute force, round trips or held-out labels."""

from __future__ import annotations

from tidemark.llm import page_outcomes
from tidemark.llm.url_reputation import SUFFIXES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_WORDS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
bw AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN sizes ON len(w) >= n),
occ AS (SELECT dw.doc_id, dw.i, dw.n, win.item FROM dw JOIN win ON win.n = dw.n AND win.s = array_to_string(dw.w[dw.i:dw.i + dw.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""


def _strength(rows: str, n: str, bad: str, mean: str) -> str:
    noise = f"{mean} * (1 - {mean})"
    s, v, w = f"sum({n} * pow({bad} / {n} - {mean}, 2))", f"sum({noise})", f"sum({noise} * ({n} - 1))"
    return f"SELECT CASE WHEN coalesce({w}, 0) = 0 THEN 1 ELSE 1 / least(0.999e0, greatest(1e-4, ({s} - {v}) / {w})) - 1 END AS k FROM {rows} WHERE {n} > 0"


_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"


def _rules(rules: list[tuple[str, str]]) -> tuple[str, str]:
    by_length = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0])))
    cases = [(_FITS.format(h=r.partition("/")[0], p="/" + r.partition("/")[2]), v, r) for v, r in by_length]
    return "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in cases) + " END", "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v, _ in cases) + " END"


def _counts(text: str) -> str:
    own = f"string_split({text}, ' ')"
    each = [f"length({text}) - length(regexp_replace({text}, '[{c}]', '', 'g')) AS c_{k}" for k, c in page_outcomes.COUNTED.items()]
    return ", ".join([f"greatest(length({text}), 1) AS size", *each, f"len(list_distinct({own})) AS c_distinct", f"len({own}) AS c_words"])


def _bins() -> str:
    """(statistic, bin) from the columns of _counts(), as a list of structs."""
    whole = {k: "size" for k in (*page_outcomes.COUNTED, "gaps")} | {"distinct": "c_words", "words": "1000"}
    reached = {k: " + ".join(f"CAST(1000 * c_{'words' if k == 'gaps' else k} >= {of} * {e} AS INTEGER)" for e in page_outcomes.EDGES) for k, of in whole.items()}
    return "[" + ", ".join(f"{{'s': '{k}', 'b': {v}}}" for k, v in reached.items()) + "]"


def _article() -> str:
    article = f"regexp_extract(html, '{page_outcomes.ARTICLE}', 1)"
    return f"CASE WHEN {article} = '' THEN regexp_replace(html, '{page_outcomes.HIDDEN}', ' ', 'g') ELSE {article} END"


def _page_text(html: str) -> str:
    text = f"regexp_replace({html}, '{page_outcomes.TAG}', ' ', 'g')"
    for name, character in page_outcomes.REFERENCES:
        text = f"replace({text}, '{name}', '{character.replace(chr(39), chr(39) * 2)}')"
    return _spaced(text)


def _spaced(text: str) -> str:
    return f"trim(regexp_replace(coalesce({text}, ''), '{page_outcomes.BLANK}', ' ', 'g'))"


def url_reputation(rules: list[tuple[str, str]], z: float = 1.645, block_at: float = 0.5) -> str:
    rule, verdict = _rules(rules)
    bare = "regexp_replace(host, ':[0-9]*$', '')"
    numeric = f"regexp_matches({bare}, '^[0-9.]+$')"
    ends = ", ".join(f"'{s}'" for s in SUFFIXES)
    known = f"list_sort(list_filter([{ends}], lambda s: {bare} = s OR ends_with({bare}, '.' || s)), 'DESC')"
    n_labels = "len(string_split(last_part, '.'))"
    edges = len(page_outcomes.EDGES)
    odds = lambda c: f"ln((count(*) FILTER (label = {c}) + 1) / ((SELECT n{c} FROM n) + {edges + 1}.0e0))"
    unseen = f"ln(1 / ((SELECT n0 FROM n) + {edges + 1}.0e0)) - ln(1 / ((SELECT n1 FROM n) + {edges + 1}.0e0))"
    return f"""
WITH known AS (SELECT DISTINCT doc_id, quality AS label FROM labels WHERE quality IN (0, 1)),
td AS MATERIALIZED (SELECT label, {_spaced('text')} AS t FROM documents JOIN known USING (doc_id)),
n AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM td),
tc AS MATERIALIZED (SELECT label, {_counts('t')} FROM td),
tb AS (SELECT label, unnest({_bins()}) AS x FROM tc),
odds AS (SELECT x.s AS s, x.b AS b, {odds(0)} - {odds(1)} AS o FROM tb GROUP BY 1, 2),
pa AS MATERIALIZED (SELECT page_id, {_article()} AS t FROM pages),
pt AS MATERIALIZED (SELECT page_id, {_page_text('t')} AS t FROM pa),
pc AS MATERIALIZED (SELECT page_id, {_counts('t')} FROM pt WHERE t <> ''),
pb AS (SELECT page_id, unnest({_bins()}) AS x FROM pc),
ps AS (SELECT page_id, ln(((SELECT n0 FROM n) + 1.0e0) / ((SELECT n1 FROM n) + 1)) + sum(coalesce(o, {unseen})) AS z FROM pb LEFT JOIN odds ON odds.s = x.s AND odds.b = x.b GROUP BY 1),
bads AS (SELECT page_id, CASE WHEN regexp_matches({_LOWER.format("coalesce(url, '')")}, '(^|[^a-z])({'|'.join(page_outcomes.BAD_WORDS)})([^a-z]|$)') THEN 1
  WHEN (SELECT least(n0, n1) FROM n) > 0 THEN CAST(z > 0 AS INTEGER) END AS bad FROM pages LEFT JOIN ps USING (page_id)),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM u),
p AS (SELECT page_id, coalesce({_LOWER.format('raw')}, '') AS host, coalesce(regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1), '') AS path FROM h),
q AS (SELECT page_id, host, path, bad FROM p JOIN bads USING (page_id)),
parts AS (SELECT host, bad, coalesce(({known})[1], string_split({bare}, '.')[-1]) AS last_part FROM q),
hosts AS (SELECT host, any_value(CASE WHEN {numeric} THEN {bare} ELSE array_to_string(string_split({bare}, '.')[-({n_labels} + 1):], '.') END) AS domain,
  any_value(CASE WHEN {numeric} THEN {bare} ELSE last_part END) AS suffix, CAST(count(bad) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS b FROM parts GROUP BY 1),
whole AS (SELECT sum(n) AS n, (sum(b) + 0.5e0) / (sum(n) + 1) AS rate FROM hosts),
s0 AS (SELECT suffix, sum(n) AS sn, sum(b) AS sb, any_value(rate) AS m0 FROM hosts, (SELECT rate FROM whole) GROUP BY 1),
k0 AS ({_strength('s0', 'sn', 'sb', 'm0')}),
s1 AS (SELECT suffix, (sb + k * m0) / (sn + k) AS m1 FROM s0, k0),
d0 AS (SELECT suffix, domain, sum(n) AS dn, sum(b) AS db, any_value(m1) AS m1 FROM hosts JOIN s1 USING (suffix) GROUP BY 1, 2),
k1 AS ({_strength('d0', 'dn', 'db', 'm1')}),
d1 AS (SELECT suffix, domain, (db + k * m1) / (dn + k) AS m2 FROM d0, k1),
h0 AS (SELECT hosts.*, m2 FROM hosts JOIN d1 USING (suffix, domain)),
k2 AS ({_strength('h0', 'n', 'b', 'm2')}),
post AS (SELECT host, b + k * m2 AS x, n - b + k * (1 - m2) AS y FROM h0, k2),
judged AS (SELECT host, x / (x + y) - {z} * sqrt((x / (x + y)) * (1 - x / (x + y)) / (x + y + 1)) > {block_at} AND (SELECT n FROM whole) > 0 AS blocked FROM post)
SELECT page_id, host, path, {rule} AS rule, coalesce({verdict}, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict FROM q LEFT JOIN judged USING (host)
"""


_TEXT_WORDS = "list_filter(regexp_split_to_array(" + _LOWER.format("text") + r", '[\x20\x09-\x0D]+'), lambda x: x <> '')"

NEAR_DEDUP = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, coalesce({_TEXT_WORDS}, []) AS w FROM documents),
x AS (SELECT doc_id, w, least(4, len(w)) AS n, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM d WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS s FROM x),
c AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
ok AS (SELECT a, b FROM pairs JOIN c ca ON ca.doc_id = a JOIN c cb ON cb.doc_id = b WHERE 100 * k >= 80 * (ca.n + cb.n - k)),
links AS MATERIALIZED (SELECT a, b FROM ok UNION ALL SELECT b, a FROM ok),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d JOIN comp ON comp.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
