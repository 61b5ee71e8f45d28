"""DuckDB SQL for the training-data queries that SQL can express."""

#: Bare upper-case base32 of a 40-digit hexadecimal SHA-1.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + CAST(((CAST('0x' || substr({hex}, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS BIGINT)
              >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '')"""

OP2 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS x FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x) AS first FROM h)
SELECT page_id, payload_bytes, {_BASE32.format(hex='x')} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""

def _spans(kind: str, order: int, pattern: str, good: str) -> str:
    """Rows (doc_id, start, kind, ord, end) of a pattern's matches."""
    p = pattern.replace("'", "''")
    return f"""
SELECT doc_id, '{kind}' AS kind, {order} AS ord, h AS hit,
       CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x)))
            + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS BIGINT) AS s
FROM (SELECT doc_id, gaps, hits, unnest(hits) AS h, generate_subscripts(hits, 1) AS i
      FROM (SELECT doc_id, string_split_regex(t, '{p}') AS gaps, regexp_extract_all(t, '{p}') AS hits
            FROM d WHERE regexp_matches(t, '{p}')))
WHERE {good}"""


_ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
           "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?"
           "([A-Za-z0-9+/_.=-]+)")

OP4 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
f AS ({_spans("assign", 0, _ASSIGN, "length(regexp_extract(h, '" + _ASSIGN.replace("'", "''") + "', 2)) >= 12")}
UNION ALL {_spans("access", 1, "AKIA[A-Z0-9]+", "length(h) >= 18")}
UNION ALL {_spans("hex", 2, "[0-9a-f]+", "length(h) >= 16")}
UNION ALL {_spans("github", 3, "gh[pousr]_[A-Za-z0-9]{36,}", "true")}
UNION ALL {_spans("jwt", 4, "eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", "true")}
UNION ALL {_spans("pem", 5, "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true")}),
g AS (SELECT doc_id, ord, s, kind || ':' || s || ':' || (s + length(hit)) AS x FROM f),
a AS (SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access,
             count(*) FILTER (ord = 2) AS n_hex,
             string_agg(x, ',' ORDER BY s, ord) FILTER (ord < 3) AS base,
             string_agg(x, ',' ORDER BY s, ord) AS spans
      FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""


def _level(depth: int, levels: list[str], weight: str) -> str:
    """CTEs that share each parent's budget among its children by water-filling:
    the smallest capacity per weight is served first."""
    cols = ", ".join(levels[:depth])
    parent = ", ".join(levels[:depth - 1])
    by = f"PARTITION BY {parent}" if parent else ""
    source = f"c{depth} JOIN b{depth - 1} USING ({parent})" if parent else f"c{depth}, b0"
    return f"""
c{depth} AS (SELECT {cols}, CAST(3 * sum(supply) AS BIGINT) AS cap FROM leaf GROUP BY {cols}),
q{depth} AS (SELECT {cols}, cap, pb, {weight} AS w, cap / CAST({weight} AS DOUBLE) AS ratio FROM {source}),
r{depth} AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS cb, sum(w) OVER ({by}) - coalesce(sum(w) OVER before, 0) AS wl
       FROM q{depth} WINDOW before AS ({by} ORDER BY ratio, {levels[depth - 1]} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s{depth} AS (SELECT *, CAST(cap AS HUGEINT) * wl <= (CAST(pb AS HUGEINT) - cb) * w AS sat FROM r{depth}),
t{depth} AS (SELECT *, sum(CASE WHEN sat THEN cap ELSE 0 END) OVER ({by}) AS cs, sum(CASE WHEN sat THEN 0 ELSE w END) OVER ({by}) AS wo
       FROM s{depth}),
b{depth} AS (SELECT {cols}, CASE WHEN sat THEN cap ELSE CAST((CAST(pb AS HUGEINT) - cs) * w // greatest(wo, 1) AS BIGINT) END AS pb
       FROM t{depth}),"""


_N = "try_cast(regexp_extract(source, '^src(\\d+)$', 1) AS INTEGER) % 3"
OP5 = f"""
WITH d AS (SELECT doc_id, lang, source,
                  CASE {_N} WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE 'other' END AS domain,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS supply FROM d GROUP BY ALL),
b0 AS (SELECT CAST(least(sum(supply) * 4 // 5, sum(supply) * 3) AS BIGINT) AS pb FROM leaf),
{_level(1, ["domain", "lang", "source"], "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'code' THEN 2 ELSE 1 END")}
{_level(2, ["domain", "lang", "source"], "CASE lang WHEN 'en' THEN 4 WHEN 'fr' THEN 2 WHEN 'de' THEN 2 ELSE 1 END")}
{_level(3, ["domain", "lang", "source"], "CASE source WHEN 'src0' THEN 2 ELSE 1 END")}
p AS (SELECT d.*, CASE WHEN supply > 0 THEN pb // supply ELSE 0 END AS passes,
             CASE WHEN supply > 0 THEN pb % supply ELSE 0 END AS rest
      FROM d JOIN leaf USING (domain, lang, source) JOIN b3 USING (domain, lang, source)),
e AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
                                  ORDER BY md5('1:' || passes || ':' || doc_id)) AS upto FROM p)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens,
       CAST(passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM e WHERE passes + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""

OP6 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
       ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM sh),
e AS (SELECT doc_id, unnest(s) AS x FROM sh),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * i >= 80 * (x.n_shingles + y.n_shingles - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM n JOIN c USING (doc_id)
"""

OP10 = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x,
    sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS d FROM embeddings
    WHERE embedding IS NOT NULL),
g AS (SELECT * FROM v WHERE d > 0 AND isfinite(d)),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id
      WHERE list_dot_product(a.x, b.x) / (a.d * b.d) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT c.vec_id, coalesce(n, 0) AS n_links, component_id, c.vec_id = component_id AS kept
FROM c LEFT JOIN n USING (vec_id)
"""

#: crc32 of a decimal number, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
    string_split(CAST({c} AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))"""

OP11 = rf"""
WITH t AS (SELECT conv_id AS c, turn, substr(sha256(length(r) || ':' || r || x), 1, 32) AS k,
       len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w
    FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
          WHERE conv_id IS NOT NULL)),
o AS (SELECT c, list({{'k': k, 'w': w}} ORDER BY turn NULLS FIRST, k) AS s FROM t GROUP BY c),
h AS (SELECT c, s, {_CRC.format(c='c')} % 4 AS h FROM o),
b AS (SELECT h.c, list_concat(coalesce(o.s[1:h.h], []), h.s[h.h + 1:]) AS s
      FROM h LEFT JOIN o ON o.c = h.c - h.c % 20),
p AS (SELECT c, len(s) AS n, d, array_to_string(list_transform(s[1:d], lambda e: e.k), '') AS k,
             CASE WHEN d = 0 THEN 0 ELSE s[d].w END AS w
      FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM b)),
m AS (SELECT k, d, min(c) AS c, count(*) AS n, any_value(w) AS w,
             sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (n = d), '')) AS e
      FROM p GROUP BY k, d),
f AS (SELECT m.*, (SELECT count(*) FROM m x WHERE x.d = m.d + 1 AND left(x.k, 32 * m.d) = m.k) AS kids FROM m),
u AS (SELECT *, unnest(range(0, d + 1)) AS a FROM f),
g AS (SELECT left(k, CAST(32 * a AS BIGINT)) AS k, CAST(sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS BIGINT) AS leaves,
             CAST(sum((n - 1) * w) AS BIGINT) AS saved FROM u GROUP BY a, left(k, CAST(32 * a AS BIGINT)))
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, q.c AS parent_conv_id, f.n AS n_convs, f.kids AS n_children,
       g.leaves AS n_leaves, g.saved AS saved_tokens, f.e AS ends_sha256, nullif(right(f.k, 32), '') AS turn
FROM f JOIN g ON g.k = f.k LEFT JOIN f q ON f.d > 0 AND q.k = left(f.k, CAST(32 * (f.d - 1) AS BIGINT)) AND q.d = f.d - 1
"""

OP13 = """
WITH v AS (SELECT vec_id AS i, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
       list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS x
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i AS a, b.i AS b, a.l = b.l AS same, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS s
      FROM v a JOIN v b ON a.i % 50 = 0 AND a.i <> b.i AND len(a.x) = len(b.x)),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a, p.b AS p, s.b AS n, p.s AS ps, s.s AS ns,
             row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.s <= 100 * s.s AND 100 * s.s <= 95 * p.s)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, n AS negative_id, ps AS positive_score,
       ns AS negative_score FROM n WHERE r <= 3
"""

SQL = {"op2_warc": OP2, "op4_secrets": OP4, "op5_mixing": OP5, "op6_minhash": OP6, "op10_lattice": OP10, "op11_trie": OP11,
       "op13_negatives": OP13}
