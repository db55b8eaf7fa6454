"""SQL that DuckDB runs on the same tables to check each query of ``catalog.py``."""

from __future__ import annotations

from ..functions.hashing import HASH_PRIME, draw_hash_params
from . import parameters as P

_STOPWORDS = ", ".join(f"'{word}'" for word in P.STOPWORDS)
_PUNCTUATION = r"[\[\]().?!,;:]"
# Unicode white space, spelt out by code points: it is to check the library, not to share with it.
_SPACES = "".join(map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))


def _words(table: str) -> str:
    """One row per word of ``table.text``, without empty words and stopwords."""
    return f"""
      SELECT word FROM (
        SELECT unnest(string_split_regex(
                 lower(regexp_replace(text, '{_PUNCTUATION}', '', 'g')), '[{_SPACES}]')) AS word
        FROM {table})
      WHERE word <> '' AND word NOT IN ({_STOPWORDS})"""


_REVIEWS = """
  reviews AS (
    SELECT o_custkey::VARCHAR AS user_id, o_orderdate AS date FROM orders)"""

_EXPLORATION = f"""
WITH {_REVIEWS},
users AS (SELECT user_id, count(*) AS n FROM reviews GROUP BY user_id),
best_users AS (SELECT * FROM users ORDER BY n DESC, user_id LIMIT {P.TOP}),
words AS (SELECT word, count(*) AS n FROM ({_words('documents')}) GROUP BY word),
best_words AS (SELECT * FROM words ORDER BY n DESC, word LIMIT {P.TOP})
SELECT (SELECT count(*) FROM reviews) AS "A",
       (SELECT count(*) FROM reviews WHERE year(date) = {P.YEAR}) AS "B",
       (SELECT count(*) FROM users) AS "C",
       (SELECT string_agg(user_id || ':' || n, ',' ORDER BY n DESC, user_id) FROM best_users) AS "D",
       (SELECT string_agg(word, ',' ORDER BY n DESC, word) FROM best_words) AS "E"
"""

_CATEGORY_AVG = """
SELECT category, round(avg(l_quantity), 6) AS average
FROM lineitem JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS category FROM part)
  ON l_partkey = p_partkey
GROUP BY category"""

_BRANDS = """
  items AS (
    SELECT DISTINCT l_orderkey AS basket, p_brand AS item
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# Every subset of every basket, as a sorted joined list: brute force over whole baskets.
_SUBSETS = f"""
  subsets AS (
    SELECT basket, item AS last, item AS items, 1 AS size FROM counted
    UNION ALL
    SELECT s.basket, i.item, s.items || '{P.ITEM_SEPARATOR}' || i.item, s.size + 1
    FROM subsets s JOIN counted i ON i.basket = s.basket AND i.item > s.last)"""


def _brand_itemsets(min_basket_size: int) -> str:
    return f"""
WITH RECURSIVE {_BRANDS},
  counted AS (
    SELECT * FROM items WHERE basket IN (
      SELECT basket FROM items GROUP BY basket HAVING count(*) > {min_basket_size})),
{_SUBSETS}
SELECT items, size, count(*) AS support FROM subsets
GROUP BY items, size HAVING count(*) >= {P.SUPPORT}"""


_BRAND_CANDIDATES = f"""
WITH RECURSIVE {_BRANDS},
  counted AS (SELECT * FROM items),
{_SUBSETS},
  chunks AS (
    SELECT basket % {P.CHUNKS} AS chunk, count(DISTINCT basket) AS baskets FROM items GROUP BY 1),
  named AS (
    SELECT basket % {P.CHUNKS} AS chunk, items, size, count(*) AS support
    FROM subsets GROUP BY 1, 2, 3)
SELECT items, size, count(*) AS chunks FROM named JOIN chunks USING (chunk)
WHERE support * (SELECT sum(baskets) FROM chunks) >= {P.SUPPORT} * baskets
GROUP BY items, size"""

# Every itemset with the list of its baskets, grown by one larger item at a time.
_SUPPLIER_ITEMSETS = f"""
WITH RECURSIVE
  ones AS (
    SELECT l_suppkey AS item, list(DISTINCT l_partkey) AS baskets
    FROM lineitem GROUP BY l_suppkey HAVING count(DISTINCT l_partkey) >= {P.SUPPLIER_SUPPORT}),
  grown AS (
    SELECT item::VARCHAR AS items, item AS last, 1 AS size, baskets FROM ones
    UNION ALL
    SELECT g.items || '{P.ITEM_SEPARATOR}' || o.item, o.item, g.size + 1,
           list_intersect(g.baskets, o.baskets)
    FROM grown g JOIN ones o ON o.item > g.last
    WHERE len(list_intersect(g.baskets, o.baskets)) >= {P.SUPPLIER_SUPPORT})
SELECT items, size, len(baskets)::BIGINT AS support FROM grown"""

# The same for parts and their suppliers, where only partners of a frequent pair are tried.
_SUPPLIER_PART_ITEMSETS = f"""
WITH RECURSIVE
  held AS (SELECT DISTINCT l_partkey AS item, l_suppkey AS basket FROM lineitem),
  ones AS (
    SELECT item, list(basket) AS baskets FROM held
    GROUP BY item HAVING count(*) >= {P.SUPPLIER_PART_SUPPORT}),
  pairs AS (
    SELECT x.item AS a, y.item AS b FROM held x JOIN held y ON x.basket = y.basket AND x.item < y.item
    GROUP BY 1, 2 HAVING count(*) >= {P.SUPPLIER_PART_SUPPORT}),
  grown AS (
    SELECT item::VARCHAR AS items, item AS last, 1 AS size, baskets FROM ones
    UNION ALL
    SELECT g.items || '{P.ITEM_SEPARATOR}' || o.item, o.item, g.size + 1,
           list_intersect(g.baskets, o.baskets)
    FROM grown g JOIN pairs p ON p.a = g.last JOIN ones o ON o.item = p.b
    WHERE len(list_intersect(g.baskets, o.baskets)) >= {P.SUPPLIER_PART_SUPPORT})
SELECT items, size, len(baskets)::BIGINT AS support FROM grown"""

_SETS = """
  sets AS (
    SELECT DISTINCT l_suppkey AS b, o_custkey AS u
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_PARAMETERS = ", ".join(
    f"({slot}, {p.a}, {p.b})"
    for slot, p in enumerate(draw_hash_params(P.BANDS * P.BAND_ROWS, P.SEED))
)

_SIGNATURES = f"""
  parameters(slot, pa, pb) AS (VALUES {_PARAMETERS}),
  signatures AS (
    SELECT b, slot, min((pa::BIGINT * (u % {HASH_PRIME}) + pb) % {HASH_PRIME}) AS minimum
    FROM sets CROSS JOIN parameters GROUP BY b, slot),
  bands AS (
    SELECT b, slot // {P.BAND_ROWS} AS band, string_agg(minimum::VARCHAR, ',' ORDER BY slot) AS minima
    FROM signatures GROUP BY b, band)"""

_SIMILAR = f"""
  sizes AS (SELECT b, count(*) AS n FROM sets GROUP BY b),
  shared AS (
    SELECT x.b AS b1, y.b AS b2, count(*) AS k
    FROM sets x JOIN sets y ON x.u = y.u AND x.b < y.b GROUP BY 1, 2),
  similar_sets AS (
    SELECT b1, b2, k::DOUBLE / (p.n + q.n - k)::DOUBLE AS sim
    FROM shared JOIN sizes p ON p.b = b1 JOIN sizes q ON q.b = b2
    WHERE k::DOUBLE / (p.n + q.n - k)::DOUBLE >= {P.SIMILARITY}::DOUBLE)"""

_SIMILAR_ALL = f"WITH {_SETS}, {_SIMILAR} SELECT b1, b2, sim FROM similar_sets"

_SIMILAR_LSH = f"""
WITH {_SETS}, {_SIGNATURES}, {_SIMILAR},
  candidates AS (
    SELECT DISTINCT x.b AS b1, y.b AS b2
    FROM bands x JOIN bands y ON x.band = y.band AND x.minima = y.minima AND x.b < y.b)
SELECT b1, b2, sim FROM similar_sets JOIN candidates USING (b1, b2)"""


def _similar_documents(threshold: float) -> str:
    """Documents as sets of words, stopwords included."""
    return f"""
WITH sets AS (
    SELECT DISTINCT doc_id AS b, word AS u FROM (
      SELECT doc_id, unnest(string_split_regex(
               lower(regexp_replace(text, '{_PUNCTUATION}', '', 'g')), '[{_SPACES}]')) AS word
      FROM documents)
    WHERE word <> ''),
{_SIMILAR.replace(f"{P.SIMILARITY}::DOUBLE", f"{threshold}::DOUBLE")}
SELECT b1, b2, sim FROM similar_sets"""


# Murmur3 of a 64-bit key with seed 42, in unsigned arithmetic modulo 2**32.
_MASK = 4294967295


def _rotate(value: str, bits: int) -> str:
    return f"(((({value}) << {bits}) | (({value}) >> {32 - bits})) & {_MASK})"


def _times(value: str, factor: int) -> str:
    return f"((({value}) * {factor}::UBIGINT) & {_MASK})"


def _hash_layout(table: str, key: str) -> str:
    """Rows of each partition, by Spark's hash of one 64-bit key."""
    return f"""
WITH words AS (
    SELECT ({key} & {_MASK})::UBIGINT AS low, (({key} >> 32) & {_MASK})::UBIGINT AS high
    FROM {table}),
  scrambled AS (SELECT {_times('low', 0xCC9E2D51)} AS low, {_times('high', 0xCC9E2D51)} AS high FROM words),
  mixed AS (
    SELECT {_times(_rotate('low', 15), 0x1B873593)} AS low,
           {_times(_rotate('high', 15), 0x1B873593)} AS high FROM scrambled),
  h0 AS (SELECT xor(42::UBIGINT, low) AS h, high FROM mixed),
  h1 AS (SELECT ({_rotate('h', 13)} * 5 + {0xE6546B64}) & {_MASK} AS h, high FROM h0),
  h2 AS (SELECT xor(h, high) AS h FROM h1),
  h3 AS (SELECT ({_rotate('h', 13)} * 5 + {0xE6546B64}) & {_MASK} AS h FROM h2),
  f0 AS (SELECT xor(h, 8::UBIGINT) AS h FROM h3),
  f1 AS (SELECT {_times('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM f0),
  f2 AS (SELECT {_times('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM f1),
  f3 AS (SELECT xor(h, h >> 16)::BIGINT AS h FROM f2),
  signed AS (SELECT CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS h FROM f3),
  placed AS (SELECT ((h % {P.PARTITIONS} + {P.PARTITIONS}) % {P.PARTITIONS})::INTEGER AS part FROM signed)
SELECT p.part::INTEGER AS partition, count(placed.part) AS "rows"
FROM range({P.PARTITIONS}) AS p(part) LEFT JOIN placed ON placed.part = p.part
GROUP BY p.part"""

_ORDER_LAYOUT = _hash_layout("orders", "o_orderkey")

_LINE_CATEGORIES = f"""
WITH listed AS (
  SELECT p_partkey, trim(unnest(string_split(concat_ws(' , ', p_name, p_type, p_type), ','))) AS category
  FROM part),
averages AS (
  SELECT category, avg(l_quantity) AS average
  FROM lineitem JOIN listed ON l_partkey = p_partkey GROUP BY category)
SELECT row_number() OVER (ORDER BY round(average, 6) DESC, category) - 1 AS place,
       category, round(average, 6) AS average
FROM averages ORDER BY place LIMIT {P.TOP}"""

_BUSY = f"SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey HAVING count(*) > {P.BUSY}"

_MODEL = f"""
  ratings AS (
    SELECT o_custkey AS u, l_partkey AS i, avg(l_quantity) AS r
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
  moments AS (
    SELECT a.i AS item_1, b.i AS item_2, count(*) AS n, sum(a.r) AS sx, sum(b.r) AS sy,
           sum(a.r * a.r) AS sxx, sum(b.r * b.r) AS syy, sum(a.r * b.r) AS sxy
    FROM ratings a JOIN ratings b ON a.u = b.u AND a.i < b.i
    GROUP BY ALL HAVING count(*) >= {P.CO_RATERS}),
  model AS (
    SELECT item_1, item_2, n AS co_raters,
           round((n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)), 9) AS weight
    FROM moments WHERE (n * sxx - sx * sx) * (n * syy - sy * sy) > 0)"""

_PREDICTIONS = f"""
WITH {_MODEL},
near AS (
  SELECT w.u, w.i, m.weight, o.r
  FROM ratings w
  JOIN (SELECT item_1 AS i, item_2 AS other, weight FROM model UNION ALL SELECT item_2, item_1, weight FROM model) m
    ON m.i = w.i AND m.weight > 0
  JOIN ratings o ON o.u = w.u AND o.i = m.other
  QUALIFY row_number() OVER (PARTITION BY w.u, w.i ORDER BY m.weight DESC, m.other) <= {P.NEIGHBOURS}),
best AS (SELECT u, i, count(*) AS neighbours, sum(weight * r) / sum(weight) AS p FROM near GROUP BY ALL),
means AS (SELECT i, avg(r) AS mean FROM ratings GROUP BY i)
SELECT u AS "user", i AS item, coalesce(neighbours, 0) AS neighbours, round(coalesce(p, mean), 6) AS prediction
FROM ratings LEFT JOIN best USING (u, i) JOIN means USING (i)"""

ORACLE: dict[str, str] = {
    "review_count": 'SELECT count(*) AS "rows" FROM events',
    "orders_in_year": f'SELECT count(*) AS "rows" FROM orders WHERE year(o_orderdate) = {P.YEAR}',
    "distinct_users": 'SELECT count(*) AS "distinct" FROM (SELECT DISTINCT user_id FROM events)',
    "user_counts": "SELECT user_id, count(*) AS count FROM events GROUP BY user_id",
    "top_users": f"""
SELECT user_id, count(*) AS count FROM events GROUP BY user_id
ORDER BY count DESC, user_id LIMIT {P.TOP}""",
    "document_words": f"SELECT word, count(*) AS count FROM ({_words('documents')}) GROUP BY word",
    "top_document_words": f"""
SELECT word, count(*) AS count FROM ({_words('documents')}) GROUP BY word
ORDER BY count DESC, word LIMIT {P.TOP}""",
    "exploration": _EXPLORATION,
    "category_avg": _CATEGORY_AVG,
    "best_categories": f"""
SELECT * FROM ({_CATEGORY_AVG}) ORDER BY average DESC, category LIMIT {P.TOP}""",
    "compact_name_counts": r"""
SELECT category, count(*) AS count FROM (
  SELECT unnest(string_split(regexp_replace(concat_ws(',', p_name, p_type), '\s', '', 'g'), ',')) AS category
  FROM part)
GROUP BY category""",
    "busy_parts": _BUSY,
    "order_layout": _ORDER_LAYOUT,
    "order_layout_as_read": 'SELECT count(*) AS "rows", true AS ids_run_on FROM orders',
    "brand_itemsets": _brand_itemsets(0),
    "brand_itemsets_large_orders": _brand_itemsets(P.BASKET_SIZE),
    "supplier_itemsets": _SUPPLIER_ITEMSETS,
    "supplier_part_itemsets": _SUPPLIER_PART_ITEMSETS,
    "supplier_part_itemsets_two_pass": _SUPPLIER_PART_ITEMSETS,
    "brand_candidates": _BRAND_CANDIDATES,
    "brand_itemsets_two_pass": _brand_itemsets(0),
    "supplier_signatures": f"WITH {_SETS}, {_SIGNATURES} SELECT b AS key, slot, minimum FROM signatures",
    "supplier_buckets": f"""
WITH {_SETS}, {_SIGNATURES}
SELECT band::INTEGER AS band, minima, count(*) AS sets FROM bands GROUP BY band, minima HAVING count(*) > 1""",
    "similar_suppliers": _SIMILAR_ALL,
    "similar_suppliers_lsh": _SIMILAR_LSH,
    "similar_documents": _similar_documents(P.DOCUMENT_SIMILARITY),
    "equal_documents_lsh": _similar_documents(1.0),
    "basket_text_items": f"WITH {_BRANDS} SELECT item, count(*) AS count FROM items GROUP BY item",
    "basket_text_itemsets": f"""
SELECT *, true AS named, false AS swapped FROM ({_brand_itemsets(0)})
UNION ALL SELECT *, true, true FROM ({_brand_itemsets(0)})""",
    "review_json_pairs": f"""
SELECT least('s' || b1, 's' || b2) AS b1, greatest('s' || b1, 's' || b2) AS b2, sim FROM ({_SIMILAR_ALL})""",
    "review_json_report": _EXPLORATION,
    "review_json_categories": _LINE_CATEGORIES,
    "busy_report_json": f"""
SELECT l_partkey::VARCHAR AS business_id, count FROM ({_BUSY})
UNION ALL SELECT 'partition ' || partition, "rows" FROM ({_hash_layout('lineitem', 'l_orderkey')})""",
    "itemset_files": f"""
SELECT items, size, chunks AS count, 'candidates' AS kind FROM ({_BRAND_CANDIDATES})
UNION ALL SELECT items, size, support, 'frequent' FROM ({_brand_itemsets(0)})""",
    "similar_pair_files": _SIMILAR_ALL,
    "part_correlations": f"WITH {_MODEL} SELECT * FROM model",
    "part_predictions": _PREDICTIONS,
}
