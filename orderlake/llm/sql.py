"""DuckDB SQL for the contract queries that SQL can express, over the whole tables."""

OP1 = r"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k
  FROM sizes GROUP BY source
), weights AS (
  SELECT source, source_size, [5.0, 2.0, 1.0][k + 1]::DOUBLE AS w, [0.5, 1.0, 1.5][k + 1]::DOUBLE AS r0,
         [1.5, 1.0, 0.5][k + 1]::DOUBLE AS r1, 2 * source_size::DOUBLE AS cap FROM ranked
), levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS l
  FROM weights
), goals AS (
  SELECT *, least(cap, coalesce(max(CASE WHEN l * w <= cap THEN l END) OVER () * w, cap)) AS target,
         w * r0 AS w0, w * r1 AS w1 FROM levels
), placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.w0, g.w1,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY
           ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || '|' || s.size::VARCHAR), 1, 15))::BIGINT, s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
  FROM sizes s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), taken AS (
  SELECT *, greatest(0, least(size, floor(target)::BIGINT - pos)) AS t0,
         greatest(0, least(size, floor(target)::BIGINT - pos - source_size)) AS t1 FROM placed
), timed AS (
  SELECT *, (pos + t0 / 2.0::DOUBLE) / target * ((w0 + w1) / 2) AS need FROM taken
)
SELECT doc_id, size, source_size, target, (t0 + t1)::BIGINT AS taken,
       CASE WHEN t0 > 0 THEN floor(CASE WHEN w0 = w1 THEN need / w0 ELSE
         need * 2 / (w0 + sqrt(greatest(w0 * w0 + (w1 - w0) * need * 2, 0.0::DOUBLE))) END * 1000000000)::BIGINT END AS position
FROM timed
"""

OP6 = r"""
WITH doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents
), item_words AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM item_words WHERE len(ws) > 0)
), probes AS (
  SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM windows) WHERE len(ws) >= n)
), hits AS (
  SELECT p.r, p.i, p.n, b.item_id FROM probes p JOIN windows b ON p.n = b.n AND p.w = b.w
), hit_words AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(t.n_items, 0)::BIGINT AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (r) LEFT JOIN hit_items t USING (r)
"""

OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d, (SELECT unnest([3, 10, 101]) AS n) WHERE len(ws) >= n)
), repeated AS (
  SELECT r, n, i FROM (SELECT *, count(*) OVER (PARTITION BY r, n, w) AS c FROM windows) WHERE c > 1
), words AS (
  SELECT r, count(DISTINCT CASE WHEN n = 3 THEN j END) AS n_repeat_words,
         count(DISTINCT CASE WHEN n = 10 THEN j END) AS covered_words, max(n) AS longest
  FROM (SELECT r, n, unnest(range(i, i + n)) AS j FROM repeated) GROUP BY r
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(covered_words, 0)::BIGINT AS covered_words,
         coalesce(longest, 0) AS longest
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r)
)
SELECT * EXCLUDE (longest), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND covered_words <= n_words * 0.3::DOUBLE AND longest < 101 AS kept
FROM m
"""

OP7 = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < original THEN original END AS refers_to
FROM g
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS s
  FROM (SELECT r, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)
), sizes AS MATERIALIZED (SELECT r, count(*) AS n FROM shingles GROUP BY r
), links AS MATERIALIZED (
  SELECT a.r AS x, b.r AS y FROM shingles a JOIN shingles b ON a.s = b.s AND a.r <> b.r
  JOIN sizes p ON p.r = a.r JOIN sizes q ON q.r = b.r
  GROUP BY a.r, b.r, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reach AS (
  SELECT r AS x, r AS y FROM d
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(e.doc_id) AS component_id
FROM d JOIN reach ON d.r = reach.x JOIN d e ON e.r = reach.y LEFT JOIN sizes ON sizes.r = d.r GROUP BY d.r, d.doc_id
"""



def crc32(text: str) -> str:
    """DuckDB's SQL for the unsigned crc32 of an ASCII text, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]::BIGINT[]))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), "
            "lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)")


def _merkle(tag: str, leaves: str) -> str:
    """CTEs nodes, siblings and walks over ``leaves`` (r, g, i, n, digest, shown, proof)."""
    return f"""
nodes{tag}(g, level, i, n, digest) AS (
  SELECT g, 0, i, n, digest FROM (SELECT DISTINCT g, i, n, digest FROM {leaves})
  UNION ALL
  SELECT g, level + 1, i // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY i))
  FROM nodes{tag} WHERE n > 1 GROUP BY g, level, i // 16
), siblings{tag} AS (
  SELECT a.g, a.level, a.i, coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS before,
         coalesce(string_agg(b.digest, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS after
  FROM nodes{tag} a JOIN nodes{tag} b ON a.g = b.g AND a.level = b.level AND a.i // 16 = b.i // 16
  WHERE a.n > 1 GROUP BY ALL
), walks{tag}(r, g, level, i, n, shown, proof) AS (
  SELECT r, g, 0, i, n, shown, proof FROM {leaves}
  UNION ALL
  SELECT w.r, w.g, w.level + 1, w.i // 16, (w.n + 15) // 16, sha256(s.before || w.shown || s.after), w.proof || s.before || s.after
  FROM walks{tag} w JOIN siblings{tag} s ON w.g = s.g AND w.level = s.level AND w.i = s.i WHERE w.n > 1
)"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_META = " || ".join(_field(f) for f in ("doc_id", "source", "lang", "n_chars"))

OP11 = f"""
WITH RECURSIVE hashed AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS g, sha256({_META} || {_field("text")}) AS digest,
         CASE WHEN {crc32("doc_id::VARCHAR")} % 5 = 0 THEN sha256({_META} || {_field(_LOWER)}) END AS other
  FROM documents
), leaves AS MATERIALIZED (
  SELECT *, coalesce(other, digest) AS shown, '' AS proof, count(*) OVER (PARTITION BY g) AS n,
         row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest, coalesce(other, digest)) - 1 AS i FROM hashed
), {_merkle("1", "leaves")}, subroots AS MATERIALIZED (
  SELECT g AS source, digest, count(*) OVER () AS n, row_number() OVER (ORDER BY g) - 1 AS i FROM nodes1 WHERE n = 1
), climbed AS MATERIALIZED (
  SELECT w.r, '' AS g, s.i, s.n, s.digest, w.shown, w.proof FROM walks1 w JOIN subroots s ON w.g = s.source WHERE w.n = 1
), {_merkle("2", "climbed")}
SELECT l.doc_id, l.digest AS leaf, c.digest AS subroot, t.digest AS root, sha256(w.proof) AS proof_sha256,
       w.shown AS folded_root, w.shown = t.digest AS verified
FROM leaves l JOIN climbed c USING (r) JOIN walks2 w USING (r), nodes2 t WHERE w.n = 1 AND t.n = 1
"""

OP13 = f"""
WITH turns AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, digest, bytes) AS pos FROM (
    SELECT conv_id AS c, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
           strlen(coalesce(text, ''))::BIGINT AS bytes FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
  SELECT c, max(pos) AS len, {crc32("c::VARCHAR")} % 9 AS h FROM turns GROUP BY c
), paths AS MATERIALIZED (
  SELECT c, pos, bytes, sha256(string_agg(digest, '' ORDER BY pos) OVER (PARTITION BY c ORDER BY pos)) AS id FROM (
    SELECT v.c, t.pos, t.digest, t.bytes FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 WHERE t.pos <= v.h
    UNION ALL
    SELECT v.c, t.pos - v.h + least(v.h, coalesce(e.len, 0)), t.digest, t.bytes
    FROM convs v JOIN turns t ON t.c = v.c LEFT JOIN convs e ON e.c = v.c - v.c % 5 WHERE t.pos > v.h)
  UNION ALL SELECT c, 0, 0, 'root' FROM convs
), steps AS (
  SELECT *, lag(id) OVER (PARTITION BY c ORDER BY pos) AS parent, lead(id) OVER (PARTITION BY c ORDER BY pos) AS next FROM paths
), nodes AS MATERIALIZED (
  SELECT id, min(c) AS conv_id, any_value(pos)::BIGINT AS depth, any_value(parent) AS parent, count(*) AS n_convs,
         any_value(bytes) AS bytes, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (next IS NULL), '')) AS ends_sha256
  FROM steps GROUP BY id
), children AS (
  SELECT parent, count(*) AS n_children FROM nodes GROUP BY parent
), below AS (
  SELECT p.id, sum((v.n_convs - 1) * v.bytes)::BIGINT AS saved_tokens, count(*) FILTER (k.n_children IS NULL) AS n_leaves
  FROM nodes v JOIN paths p ON p.c = v.conv_id AND p.pos <= v.depth LEFT JOIN children k ON k.parent = v.id GROUP BY p.id
)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
       b.saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.id = n.id LEFT JOIN nodes m ON m.id = n.parent LEFT JOIN children k ON k.parent = n.id
"""

ORACLES = {"op1_mix_sources": OP1, "op5_suffix_repetition": OP5, "op6_decontaminate": OP6, "op7_warc_revisits": OP7,
           "op10_jaccard_join": OP10, "op11_merkle_manifest": OP11, "op13_prefix_trie": OP13}
