"""The same queries in DuckDB SQL, where SQL can express them."""

_NORMAL = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLES: dict[str, str] = {
    "op5_decontamination": f"""
WITH d AS (SELECT doc_id, {_NORMAL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_NORMAL} AS w FROM benchmark WHERE item_id IS NOT NULL),
g AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
            FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT doc_id, n, i, item FROM p JOIN g USING (n, gram)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h)
      GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
""",
    "op2_substring": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 35)) AS k FROM s SEMI JOIN r USING (g))),
p AS (SELECT doc_id, k, w[k] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM p ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
""",
    "op9_suffix_array": """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h, strlen(coalesce(text, '')) AS n FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g
      FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM d WHERE n >= 50)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 50)) AS k
                                         FROM s JOIN f USING (g) WHERE first < doc_id)),
b AS (SELECT doc_id, k, substr(h, 2 * k + 1, 2) AS byte FROM (SELECT doc_id, h, unnest(range(0, n)) AS k FROM d)),
kept AS (SELECT doc_id, string_agg(byte, '' ORDER BY k) AS t FROM b ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id),
r AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < k - 1) AS n_spans
      FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM gone) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(t, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN r USING (doc_id)
""",
    "op12_importance": f"""
WITH docs AS (SELECT doc_id, {_NORMAL} AS w FROM documents), items AS (SELECT {_NORMAL} AS w FROM benchmark),
crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v
  FROM range(256) r(i))),
dw AS (SELECT doc_id, unnest(w) AS word FROM docs), bw AS (SELECT unnest(w) AS word FROM items),
distinct_words AS (SELECT word, hex(word) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
bucket AS MATERIALIZED (SELECT word, xor(4294967295, list_reduce(
    list_transform(range(strlen(word)), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295)) % 10000 AS b FROM distinct_words, crc),
s AS (SELECT b, count(*) AS n FROM dw JOIN bucket USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bw JOIN bucket USING (word) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln(CAST((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000) AS DOUBLE)
    / CAST((s.n + 1) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000) AS DOUBLE))) AS BIGINT) AS g
  FROM s LEFT JOIN t USING (b)),
f AS (SELECT doc_id, count(*) AS n, CAST(sum(g) AS BIGINT) AS weight
      FROM dw JOIN bucket USING (word) JOIN gain USING (b) GROUP BY doc_id),
k AS (SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN f USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM k WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM r) THEN rank END AS rank
FROM k LEFT JOIN r USING (doc_id)
""",
}


def _codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The rounds of op11 one after another. Components are small enough for exact doubles."""
    def assigned(r: int) -> str:
        return f"""
a{r} AS MATERIALIZED (SELECT id, p, x, arg_min(e, (d, e)) AS e, CAST(min(d) AS BIGINT) AS d FROM (
  SELECT s.id, s.p, x, e, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d
  FROM s JOIN c{r} USING (p)) GROUP BY id, p, x)"""

    def averaged(r: int) -> str:
        return f"""
m{r} AS (SELECT p, e, list(v ORDER BY i) AS c FROM (
  SELECT p, e, i, CAST(floor(sum(CAST(x[i] AS BIGINT))::DOUBLE / count(*)) AS DOUBLE) AS v
  FROM a{r}, range(1, 1 + (SELECT min(len(x)) FROM s)) t(i) GROUP BY p, e, i) GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (p, e))"""

    steps = ",".join(assigned(r) + "," + averaged(r) for r in range(rounds))
    return f"""
WITH v AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id, embedding) AS id,
    list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT id, p, w[p * len(w) // {parts} + 1:(p + 1) * len(w) // {parts}] AS x FROM v, range({parts}) r(p)),
c0 AS MATERIALIZED (SELECT p, id - 1 AS e, x AS c FROM s WHERE id <= {entries}),{steps},{assigned(rounds)},
k AS (SELECT id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY id),
b AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY p, e)) AS h
      FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN k USING (id), b
"""


ORACLES["op11_codes"] = _codes()
