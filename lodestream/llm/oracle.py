"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

from . import secrets


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The same definitions in the other engine's dialect, where a case-blind group would fold letters beyond ASCII.
_ASSIGN = "(" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + f"|{_any_case('api')}_?{_any_case('key')}" + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def _spans() -> str:
    parts = []
    for k, r in enumerate(secrets.RULES):
        p = (_ASSIGN if r.kind == "assign" else r.pattern).replace("'", "''")
        parts.append(
            f"SELECT doc_id, {k} AS kind, '{r.kind}' AS name, {r.least} AS least, string_split_regex(t, '{p}') AS ps, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {r.group}) AS gs"
            f" FROM d WHERE regexp_matches(t, '{p}')"
        )
    base = ", ".join(str(k) for k, r in enumerate(secrets.RULES) if r.base)
    show = "name || ':' || a || ':' || (a + n), ',' ORDER BY a, kind"
    counts = ", ".join(f"count(*) FILTER (WHERE kind = {k}) AS n_{r.kind}" for k, r in enumerate(secrets.RULES) if r.base)
    zero = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.RULES if r.base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), r AS ({' UNION ALL '.join(parts)}),
      e AS (SELECT doc_id, kind, name, length(gs[i]) >= least AS ok, length(ms[i]) AS n,
        CAST(list_sum(list_transform(list_slice(ps, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(ms, 1, i - 1), lambda x: length(x))), 0) AS BIGINT) AS a
        FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM r)),
      f AS (SELECT doc_id, {counts}, string_agg({show}) FILTER (WHERE kind IN ({base})) AS base, string_agg({show}) AS spans FROM e WHERE ok GROUP BY doc_id)
      SELECT doc_id, {zero}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN f USING (doc_id)"""


_WORDS = r"regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10ffff}]+')"
_FIVE = """SELECT DISTINCT id, CASE WHEN len(w) >= 5 THEN array_to_string(list_slice(w, k, k + 4), ' ') ELSE len(w) || ':' || array_to_string(w, ' ') END AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM (SELECT {id} AS id, {w} AS w FROM {t}) WHERE len(w) > 0)"""
CONTAINED = f"""WITH i AS MATERIALIZED ({_FIVE.format(id='item_id', w=_WORDS, t='benchmark')}), d AS ({_FIVE.format(id='doc_id', w=_WORDS, t='documents')}), n AS (SELECT id, count(*) AS n FROM i GROUP BY 1),
  m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY ALL)
  SELECT doc_id, item_id, n AS n_item, n_shared, n_shared / n::DOUBLE AS containment FROM m JOIN n ON n.id = item_id WHERE n_shared >= 0.8 * n - 1e-9"""

_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR = rf"""WITH RECURSIVE s AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 2 THEN w[k] || ' ' || w[k + 1] ELSE w[1] END AS x
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS k FROM (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents) WHERE len(w) > 0)),
  n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)),
  e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  c AS (SELECT a AS v, a AS r FROM e UNION SELECT e.b, c.r FROM c JOIN e ON e.a = c.v WHERE c.r < e.b),
  m AS (SELECT v, min(r) AS r FROM c GROUP BY 1)
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(m.r, d.doc_id), d.doc_id) AS component_id, coalesce(least(m.r, d.doc_id), d.doc_id) = d.doc_id AS kept
  FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.v = d.doc_id"""

PHRASES = rf"""WITH p AS (SELECT lang, regexp_extract_all(unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang, coalesce({_LOW}, '') AS t FROM documents)),
  w AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
  o AS MATERIALIZED (SELECT lang, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM w),
  s1 AS MATERIALIZED (SELECT lang, a, count(*) AS f FROM o GROUP BY ALL),
  s2 AS MATERIALIZED (SELECT lang, a, b, count(*) AS f FROM o WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
  s3 AS MATERIALIZED (SELECT lang, a, b, c, count(*) AS f FROM o WHERE c IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
  n AS (SELECT lang, sum(f)::BIGINT AS n FROM s1 GROUP BY 1),
  x AS (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, a, b, f FROM s3 UNION ALL SELECT lang, b, c, f FROM s3) GROUP BY ALL),
  c2 AS (SELECT s2.lang, s2.a || ' ' || s2.b AS phrase, s2.f AS a, u.f AS l, v.f AS r, 1 AS k FROM s2 JOIN s1 u ON u.lang = s2.lang AND u.a = s2.a JOIN s1 v ON v.lang = s2.lang AND v.a = s2.b
    LEFT JOIN x ON x.lang = s2.lang AND x.a = s2.a AND x.b = s2.b WHERE x.f IS NULL OR 100 * x.f < 50 * s2.f),
  c3 AS (SELECT s3.lang, s3.a || ' ' || s3.b || ' ' || s3.c AS phrase, s3.f AS a, u.f AS l, v.f AS r, 1 AS k FROM s3 JOIN s1 u ON u.lang = s3.lang AND u.a = s3.a JOIN s2 v ON v.lang = s3.lang AND v.a = s3.b AND v.b = s3.c
    UNION ALL SELECT s3.lang, s3.a || ' ' || s3.b || ' ' || s3.c, s3.f, u.f, v.f, 2 FROM s3 JOIN s2 u ON u.lang = s3.lang AND u.a = s3.a AND u.b = s3.b JOIN s1 v ON v.lang = s3.lang AND v.a = s3.c),
  e AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM (SELECT * FROM c2 UNION ALL SELECT * FROM c3)),
  m AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
  SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m) JOIN n USING (lang) WHERE rank <= 2000"""

# CRC-32 by nibbles: a table of 16 entries, made by the polynomial's rule.


def _crc(table: list[int]) -> str:
    t = "[" + ", ".join(f"{x}::BIGINT" for x in table) + "]"
    half = lambda c, b: f"xor({t}[(xor({c}, {b}) & 15) + 1], {c} >> 4)"
    inner = half("c", "b")
    return f"xor(list_reduce(bs, lambda c, b: {half(inner, '(b >> 4)')}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _nibble_table() -> list[int]:
    out = []
    for n in range(16):
        for _ in range(4):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


# The heap one group at a time; of a run of equal sizes the shards are then given out in order of the text's hash.
SHARDS = f"""WITH RECURSIVE r AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 16 AS size, sha256(coalesce(text, '')) AS k FROM documents),
  o AS MATERIALIZED (SELECT k, load, row_number() OVER (ORDER BY load DESC, k) AS i FROM (SELECT k, CAST(sum(size) AS BIGINT) AS load FROM r GROUP BY k)),
  p AS (SELECT 0::BIGINT AS i, list_transform(range(40), lambda x: 0::BIGINT) AS loads, -1::BIGINT AS shard
    UNION ALL SELECT o.i, list_transform(loads, lambda x, j: x + CASE WHEN j = list_position(loads, list_min(loads)) THEN load ELSE 0 END), list_position(loads, list_min(loads)) - 1 FROM p JOIN o ON o.i = p.i + 1),
  a AS (SELECT load, shard, row_number() OVER (PARTITION BY load ORDER BY shard) AS q FROM p JOIN o USING (i)),
  b AS (SELECT k, load, row_number() OVER (PARTITION BY load ORDER BY k) AS q FROM o),
  c AS MATERIALIZED (SELECT k, {_crc(_nibble_table())} AS crc FROM (SELECT k, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: CAST('0x' || x AS BIGINT)) AS bs FROM (SELECT DISTINCT k, t FROM r)))
  SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY substring(sha256(concat_ws(':', doc_id, k)), 1, 2), doc_id, k) - 1 AS slot, NULL::INT AS grown_shard
  FROM r JOIN b USING (k) JOIN a USING (load, q) JOIN c USING (k)"""

ORACLE = {"op1_secret_scan": _spans(), "op3_decontamination": CONTAINED, "op4_sharding": SHARDS, "op6_near_duplicates": NEAR, "op11_collocations": PHRASES}
