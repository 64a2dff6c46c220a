"""DuckDB SQL for the corpus queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op4_chat_text"] = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, count(*) OVER (PARTITION BY conv_id) AS n,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS place
  FROM turns WHERE conv_id IS NOT NULL
  UNION ALL SELECT *, 1, 1 FROM turns WHERE conv_id IS NULL
),
rolled AS (
  SELECT conv_id, n, place, CASE WHEN conv_id IS NULL THEN [{'r': role, 't': text}]
    ELSE list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY place) END AS so_far
  FROM placed
),
kept AS (
  SELECT min(conv_id) AS conv_id, n AS turns, count(*) AS copies
  FROM rolled WHERE place = n AND so_far NOT IN (SELECT so_far FROM rolled WHERE place < n)
  GROUP BY n, so_far
)
SELECT k.conv_id, CAST((p.place - 1) // 64 AS BIGINT) AS segment, k.turns, k.copies,
  string_agg('<|' || coalesce(p.role, '') || '|>' || chr(10) || coalesce(p.text, '') || chr(10) || '<|end|>' || chr(10), ''
    ORDER BY p.place) AS text
FROM kept k JOIN placed p ON k.conv_id = p.conv_id
GROUP BY ALL
"""

WORD_ROWS = """
  SELECT {id}, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM (
    SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '{pattern}') AS w FROM {table}) AS t"""
ALNUM_WORDS, SPACED_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"

#: Runs of k words as text, by where they begin; no word holds a space.
RUNS = "string_agg(word, ' ') OVER (PARTITION BY {id} ORDER BY i ROWS BETWEEN CURRENT ROW AND {last} FOLLOWING)"

ORACLES["op2_benchmark_passages"] = f"""
WITH dw AS ({WORD_ROWS.format(id="doc_id", table="documents", pattern=ALNUM_WORDS)}),
iw AS ({WORD_ROWS.format(id="item_id", table="benchmark", pattern=ALNUM_WORDS)}),
item_windows AS (
  SELECT DISTINCT item_id, least(13, n) AS k,
    {RUNS.format(id="item_id", last=12)} AS run
  FROM iw QUALIFY i + least(13, n) - 1 <= n
),
lengths AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT doc_id, i, k, array_to_string(list_slice(ahead, 1, k), ' ') AS run
  FROM (SELECT doc_id, i, n, list(word) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS ahead
        FROM dw) AS t, lengths WHERE i + k - 1 <= n
),
hits AS (SELECT d.doc_id, d.i, d.k, w.item_id FROM doc_windows d JOIN item_windows w ON d.k = w.k AND d.run = w.run),
words_hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM hits) AS t GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) AS t GROUP BY doc_id
),
sizes AS (SELECT doc_id, max(n) AS n_words FROM dw GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= n_words, false) AS contaminated
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op5_near_duplicates"] = f"""
WITH RECURSIVE dw AS ({WORD_ROWS.format(id="doc_id", table="documents", pattern=SPACED_WORDS)}),
shingles AS (
  SELECT DISTINCT doc_id, {RUNS.format(id="doc_id", last=1)} AS s FROM dw QUALIFY i < n OR n = 1
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id, min(other) = d.doc_id AS kept
FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

#: A digest of a document's fields, each with its length ahead.
LEAF = "sha256(" + " || ".join(
    f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + ")"
#: Unsigned CRC-32 of a short ASCII text.
CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({text}, ''), lambda s: CAST(ord(s) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) for _ in range(8)]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))))"""


def _reduced(name: str, leaves: str) -> str:
    """Levels of trees of three: (tree, level, idx, width, h), and the siblings of each node."""
    return f"""
{name} AS (
  {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // 3, CAST(ceil(width / 3) AS BIGINT), sha256(string_agg(h, '' ORDER BY idx))
  FROM {name} WHERE width > 1 GROUP BY tree, level, idx // 3, width
),
{name}_sides AS (
  SELECT *, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name} WHERE width > 1 WINDOW run AS (PARTITION BY tree, level, idx // 3 ORDER BY idx)
)"""


ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE cut AS (
  SELECT *, CASE WHEN {CRC32.format(text="coalesce(CAST(doc_id AS VARCHAR), '')")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS shown_text
  FROM documents
),
leaves AS (SELECT doc_id, source, {LEAF.format(text="text")} AS leaf, {LEAF.format(text="shown_text")} AS shown FROM cut),
numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS width,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaves
),
{_reduced("low", "SELECT tree, 0 AS level, idx, width, leaf AS h FROM numbered")},
subroots AS (SELECT tree, h AS subroot, count(*) OVER () AS width FROM low WHERE width = 1),
{_reduced("high", "SELECT 0 AS tree, 0 AS level, tree AS idx, width, subroot AS h FROM subroots")},
steps AS (
  SELECT n.tree, n.idx, s.level AS level, s.before, s.after FROM numbered n JOIN low_sides s
    ON s.tree = n.tree AND s.idx = n.idx // CAST(3 ** s.level AS BIGINT)
  UNION ALL
  SELECT n.tree, n.idx, 1000 + s.level, s.before, s.after FROM numbered n JOIN high_sides s
    ON s.idx = n.tree // CAST(3 ** s.level AS BIGINT)
),
paths AS (SELECT tree, idx, list({{'b': before, 'a': after}} ORDER BY level) AS path FROM steps GROUP BY tree, idx),
whole AS (
  SELECT n.doc_id, n.leaf, s.subroot, (SELECT h FROM high WHERE width = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(p.path, lambda x: x.b || x.a), ''), '')) AS proof_sha256,
    list_reduce(list_prepend({{'b': '', 'a': n.shown}}, coalesce(p.path, [])),
      lambda node, x: {{'b': '', 'a': sha256(x.b || node.a || x.a)}}).a AS folded_root
  FROM numbered n JOIN subroots s USING (tree) LEFT JOIN paths p ON p.tree = n.tree AND p.idx = n.idx
)
SELECT *, folded_root = root AS verified FROM whole
"""

ORACLES["op13_fill_in_middle"] = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
),
numbers AS (
  SELECT *, CAST('0x' || substr(d, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(d, 9, 8) AS BIGINT) % (n + 1) AS y,
    CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM drawn
),
cut AS (
  SELECT *, least(x, y) AS a, greatest(x, y) - least(x, y) AS m,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
),
parts AS (SELECT *, substring(text, 1, a) AS p, substring(text, a + 1, m) AS mid, substring(text, a + m + 1) AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(m AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || mid
    ELSE '<S>' || s || '<P>' || p || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""
