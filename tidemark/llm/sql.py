"""SQL forms of the queries that SQL can express, written from the contract and not from the operators."""

from __future__ import annotations

from tidemark.llm import repetition, url_rules
from tidemark.llm.budgets import MAX_EPOCHS, PERCENT, SEED, WEIGHTS

_WORD = r"[^\x20\x09-\x0D]+"

REPETITION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS ws FROM d),
base AS (
  SELECT r, doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))
          - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))))::BIGINT AS n_dup_lines, ws
  FROM w),
runs AS (
  SELECT r, i, k.k AS k, array_to_string(ws[i:i + k.k - 1], ' ') AS t
  FROM (SELECT r, ws, n_words, unnest(range(1, n_words + 1)) AS i FROM base) CROSS JOIN (VALUES (3), ({repetition.MIN_WORDS})) k(k)
  WHERE i + k.k - 1 <= n_words),
again AS (SELECT r, i, k FROM (SELECT *, count(*) OVER (PARTITION BY r, k, t) AS c FROM runs) WHERE c > 1),
cover AS (SELECT r, k, count(DISTINCT i + j) AS n FROM (SELECT r, k, i, unnest(range(k)) AS j FROM again) GROUP BY r, k),
one AS (SELECT r, i, ws[i] AS t FROM (SELECT r, ws, unnest(range(1, n_words + 1)) AS i FROM base)),
longest AS (  -- the common prefix of two places grows along a diagonal
  SELECT r, max(c) AS n FROM (
    SELECT r, gap, count(*) AS c FROM (
      SELECT r, i, gap, i - row_number() OVER (PARTITION BY r, gap ORDER BY i) AS run FROM (
        SELECT a.r, a.i, b.i - a.i AS gap FROM one a JOIN one b ON a.r = b.r AND a.t = b.t AND a.i < b.i))
    GROUP BY r, gap, run) GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_covered_words <= {repetition.MAX_COVERED} * n_words
       AND 100 * n_longest_repeat <= {repetition.MAX_LONGEST} * n_words AS kept, n_covered_words, n_longest_repeat
FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(c3.n, 0) AS n_repeat_words, coalesce(c5.n, 0) AS n_covered_words,
         coalesce(longest.n, 0) AS n_longest_repeat
  FROM base LEFT JOIN cover c3 ON c3.r = base.r AND c3.k = 3 LEFT JOIN cover c5 ON c5.r = base.r AND c5.k = {repetition.MIN_WORDS}
  LEFT JOIN longest ON longest.r = base.r))
"""


def _weight(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in sorted(WEIGHTS[level].items()))
    return f"CASE {level} {cases} ELSE 1.0 END" if cases else "1.0"


def _level(parent: list[str], child: str, budgets: str) -> str:
    """Children's budgets: the level at which all that are not full take what is left."""
    keys = ", ".join(["root", *parent])
    on = " AND ".join(f"n.{k} = b.{k}" for k in ["root", *parent])
    by = f"PARTITION BY {keys} ORDER BY ratio, {child}"
    return f"""
  SELECT {keys}, {child}, CASE WHEN weight <= 0 THEN 0 WHEN full_ THEN capacity
         ELSE least(capacity, greatest(0, weight * coalesce(struct_extract(min(CASE WHEN NOT full_ AND weight > 0
           THEN {{'ratio': ratio, 'child': {child}, 'level': level}} END) OVER (PARTITION BY {keys}), 'level'), 0))) END AS budget
  FROM (SELECT *, weight > 0 AND ratio <= level AS full_ FROM (
    SELECT *, CASE WHEN sum(weight) OVER ({by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > 0 THEN
      (budget - coalesce(sum(capacity) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER ({by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) ELSE 0 END AS level
    FROM (SELECT n.*, b.budget, CASE WHEN weight > 0 THEN capacity / weight ELSE 'infinity'::DOUBLE END AS ratio
          FROM (SELECT {keys}, {child}, sum(tokens)::DOUBLE * {MAX_EPOCHS} AS capacity, ({_weight(child)})::DOUBLE AS weight
                FROM leaves GROUP BY ALL) n JOIN {budgets} b ON {on})))"""


BUDGETS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS id, coalesce(md5(text), '') AS text_hash,
         'd' || (CASE WHEN regexp_extract(coalesce(source, ''), '(\d{{1,9}})$', 1) = '' THEN 0
                      ELSE regexp_extract(source, '(\d{{1,9}})$', 1)::BIGINT % 4 END)::VARCHAR AS domain,
         coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
         coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS tokens
  FROM documents),
leaves AS (SELECT 0 AS root, domain, lang, source, sum(tokens)::BIGINT AS tokens FROM docs GROUP BY ALL),
b0 AS (SELECT 0 AS root, least(floor(sum(tokens) * {PERCENT} / 100.0), sum(tokens) * {MAX_EPOCHS}.0)::DOUBLE AS budget FROM leaves),
b1 AS ({_level([], "domain", "b0")}),
b2 AS ({_level(["domain"], "lang", "b1")}),
b3 AS ({_level(["domain", "lang"], "source", "b2")}),
plan AS (
  SELECT domain, lang, source, CASE WHEN tokens > 0 THEN floor(give / tokens)::INT ELSE 0 END AS whole,
         give - (CASE WHEN tokens > 0 THEN floor(give / tokens)::BIGINT ELSE 0 END) * tokens AS part
  FROM (SELECT leaves.*, floor(b3.budget + 1e-6)::BIGINT AS give FROM leaves JOIN b3 USING (domain, lang, source))),
placed AS (
  SELECT docs.*, whole, part, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY h RANGE UNBOUNDED PRECEDING) AS up_to
  FROM (SELECT docs.*, whole, part, md5('{SEED}:' || whole || ':' || id || ':' || text_hash) AS h FROM docs JOIN plan USING (domain, lang, source)) docs)
SELECT doc_id, domain, lang, source, tokens, epoch::INT AS epoch FROM (
  SELECT *, unnest(range(whole + CASE WHEN part > 0 AND up_to <= part THEN 1 ELSE 0 END)) AS epoch FROM placed)
"""

_COMPONENTS = """
names(node, low) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT links.b, names.low FROM names JOIN links ON links.a = names.node)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)]) END AS sh FROM d),
kinds AS (SELECT min(doc_id) AS node, len(sh) AS n, sh FROM (SELECT doc_id, list_sort(sh) AS sh FROM s) WHERE len(sh) > 0 GROUP BY sh),
tokens AS (SELECT node, n, unnest(sh) AS t FROM kinds),
links AS MATERIALIZED (
  SELECT a.node AS a, b.node AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
nodes AS (SELECT node FROM kinds), {_COMPONENTS}
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(c.low, s.doc_id) AS component_id
FROM s LEFT JOIN kinds ON kinds.sh = list_sort(s.sh) LEFT JOIN (SELECT node, min(low) AS low FROM names GROUP BY node) c ON c.node = kinds.node
"""

NEAR_VECTORS = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS size FROM v
       WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95),
nodes AS (SELECT vec_id AS node FROM v), {_COMPONENTS}
SELECT v.vec_id, coalesce(n.c, 0) AS n_links, l.low AS component_id, v.vec_id = l.low AS kept
FROM v LEFT JOIN (SELECT a, count(*) AS c FROM links GROUP BY a) n ON n.a = v.vec_id
JOIN (SELECT node, min(low) AS low FROM names GROUP BY node) l ON l.node = v.vec_id
"""

#: Windows of 200 bytes are compared as 400 hexadecimal digits.
REPEATS = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS k FROM (SELECT r, h, unnest(range(length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY k) AS c FROM w) WHERE c > 1),
edge AS (SELECT *, CASE WHEN i <= max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 200 THEN 0 ELSE 1 END AS new FROM hit),
span AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS g FROM edge) GROUP BY r, g),
gap AS (  -- what is left: before the first span, between spans, after the last
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS b FROM span
  UNION ALL SELECT r, max(b), NULL FROM span GROUP BY r),
kept AS (SELECT gap.r, string_agg(substr(h, 2 * gap.a + 1, 2 * (coalesce(gap.b, length(h) // 2) - gap.a)), '' ORDER BY gap.a) AS h FROM gap JOIN d USING (r) GROUP BY gap.r)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, coalesce(s.n, 0)::BIGINT AS n_removed, coalesce(s.c, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN (SELECT r, sum(b - a) AS n, count(*) AS c FROM span GROUP BY r) s USING (r) LEFT JOIN kept USING (r)
"""

def _merkle_path(name: str, rows: str, nodes: str) -> str:
    """From ``rows`` (k, tree, pos, n, proof, cur) up to the root of each row's tree: the siblings met, and what ``cur`` folds to."""
    return f"""
{name}(k, tree, level, pos, n, proof, cur) AS (
  SELECT k, tree, 0, pos, n, proof, cur FROM ({rows})
  UNION ALL
  SELECT p.k, p.tree, p.level + 1, p.pos // 3, (p.n + 2) // 3,
         p.proof || coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos <> p.pos), ''),
         sha256(coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < p.pos), '') || p.cur
                || coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > p.pos), ''))
  FROM {name} p JOIN {nodes} s ON s.tree IS NOT DISTINCT FROM p.tree AND s.level = p.level AND s.pos // 3 = p.pos // 3
  WHERE p.n > 1 GROUP BY p.k, p.tree, p.level, p.pos, p.n, p.proof, p.cur)"""


def _merkle_nodes(name: str, rows: str) -> str:
    return f"""
{name}(tree, level, pos, n, h) AS (
  SELECT tree, 0, pos, n, h FROM ({rows})
  UNION ALL
  SELECT tree, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1
  GROUP BY tree, level, pos // 3, n)"""


def _merkle_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value}::VARCHAR END"


def _merkle_leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_merkle_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


MERKLE = f"""
WITH RECURSIVE
crcs AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
docs AS (SELECT row_number() OVER () AS k, *, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
  FROM documents, crcs),
leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT k, doc_id, source, {_merkle_leaf('text')} AS leaf,
          CASE WHEN crc % 2 = 0 THEN {_merkle_leaf("replace(text, chr(10), '')")} ELSE {_merkle_leaf('text')} END AS found FROM docs)),
{_merkle_nodes('nodes', "SELECT source AS tree, pos, n, leaf AS h FROM leaves")},
subroots AS (SELECT tree AS source, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_merkle_nodes('tops', "SELECT 0 AS tree, pos, n, h FROM subroots")},
{_merkle_path('low', "SELECT k, source AS tree, pos, n, '' AS proof, found AS cur FROM leaves", 'nodes')},
{_merkle_path('high', "SELECT l.k, 0 AS tree, s.pos, s.n, l.proof, l.cur FROM low l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.tree WHERE l.n = 1", 'tops')}
SELECT v.doc_id, v.leaf, s.h AS subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.cur AS folded_root, p.cur = t.h AS verified
FROM leaves v JOIN high p ON p.k = v.k AND p.n = 1 JOIN subroots s ON s.source IS NOT DISTINCT FROM v.source, (SELECT h FROM tops WHERE n = 1) t
"""

NEAREST = """
WITH v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, q.e AS qe, c.vec_id, list_dot_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, qe ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 20
"""

_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in url_rules.RULES)


def _named(prefix: str, parts: str) -> str:
    return f"list_transform(list_filter({parts}, lambda x: x <> ''), lambda x: '{prefix}' || regexp_replace(x, '[0-9]+', '0', 'g'))"


#: Every subset of the tokens of a labelled URL is counted, and a rule is one that enough blocked URLs have.
URL_RULES = rf"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS query FROM p),
t AS (SELECT *, CASE WHEN contains(url, '://') THEN list_distinct(['scheme:' || split_part(url, '://', 1)] || {_named('host:', "string_split(host, '.')")}
        || {_named('path:', "string_split(path, '/')")}
        || {_named('query:', "list_transform(string_split(query, '&'), lambda y: split_part(y, '=', 1))")}) ELSE [] END AS tokens FROM h),
shown AS (SELECT t.r, list_sort(tokens) AS tokens, l.toxic = 1 OR l.quality = 0 AS blocked
  FROM t JOIN labels l ON l.doc_id = TRY_CAST(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT)),
sets AS (SELECT blocked, list_transform(list_filter(range(1, len(tokens) + 1), lambda i: (mask >> (i - 1)) & 1 = 1), lambda i: tokens[i]) AS s
  FROM (SELECT blocked, tokens, unnest(range(1, 1 << len(tokens))) AS mask FROM shown WHERE blocked IS NOT NULL)),
mined AS (SELECT s FROM sets GROUP BY s HAVING count_if(blocked) >= {url_rules.MIN_COUNT} AND count_if(blocked) >= {url_rules.MIN_CONFIDENCE} * count(*)),
hit AS (SELECT DISTINCT r FROM t, mined WHERE list_has_all(t.tokens, mined.s)),
rules(verdict, host, path) AS (VALUES {_RULES}),
best AS (SELECT r, arg_max(rules, (length(rules.host) + length(rules.path), rules.host, rules.path)) AS b FROM h JOIN rules
  ON (h.host = rules.host OR ends_with(h.host, '.' || rules.host)) AND starts_with(h.path, rules.path) GROUP BY r)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, b.host || b.path AS rule,
       coalesce(b.verdict, CASE WHEN hit.r IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, hit.r IS NOT NULL AS mined_block
FROM h LEFT JOIN best USING (r) LEFT JOIN hit USING (r)
"""

SQL = {
    "op1_suffix_repetition": REPETITION, "op3_hierarchical_budget": BUDGETS, "op6_induced_sorting": REPEATS,
    "op8_count_vector_join": NEAR_DUPLICATES, "op9_url_rules": URL_RULES, "op10_pivot_index": NEAR_VECTORS, "op11_multi_index_hashing": NEAREST,
    "op12_merkle_manifest": MERKLE,
}
