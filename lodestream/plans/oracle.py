"""DuckDB SQL for the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from ..functions import values as V
from . import queries as Q
from . import queries_state

WS = r"[\t\n\x0B\f\r \x{a0}\x{feff}]"
NWS = r"[^\t\n\x0B\f\r \x{a0}\x{feff}]"
CJK = r"\x{4e00}-\x{9fff}\x{3040}-\x{309f}\x{30a0}-\x{30ff}\x{ac00}-\x{d7a3}"
TOKEN = rf"[{CJK}\x{{3400}}-\x{{4dbf}}\x{{f900}}-\x{{faff}}]|[^\t\n\x0B\f\r \x{{a0}}\x{{feff}}{CJK}\x{{3400}}-\x{{4dbf}}\x{{f900}}-\x{{faff}}]+"
PARTS = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def names(words) -> str:
    return "(" + ", ".join(q(w) for w in words) + ")"


def array(words) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def table(rows, columns: str) -> str:
    show = lambda v: "NULL" if v is None else q(v) if isinstance(v, str) else str(v)
    return "(VALUES " + ", ".join("(" + ", ".join(show(v) for v in (r if isinstance(r, tuple) else (r,))) + ")" for r in rows) + f") t({columns})"


def strip(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace({c}, '<[^>]+>', ' ', 'g'), '[*_~`#\\[\\]()!]', '', 'g'), '{WS}+', ' ', 'g'))"


def norm(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({strip(c)}), '[^a-z0-9\\t\\n\\x0B\\f\\r \\x{{a0}}\\x{{feff}}]', '', 'g'), '{WS}+', ' ', 'g'))"


def part(u: str, k: int) -> str:
    return f"regexp_extract({u}, '{PARTS}', {k})"


def host(u: str) -> str:
    return f"lower(regexp_replace(regexp_replace({part(u, 2)}, '^.*@', ''), ':[0-9]*$', ''))"


def domain(u: str) -> str:
    return f"regexp_replace({host(u)}, '^www\\.', '')"


def path_key(u: str) -> str:
    path = f"CASE WHEN {part(u, 3)} = '' THEN '/' ELSE {part(u, 3)} END"
    return f"CASE WHEN {part(u, 2)} <> '' THEN {host(u)} || regexp_replace({path}, '/$', '') ELSE substring(lower({u}), 1, 200) END"


def ip(h: str) -> str:
    one = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    p = [f"CAST(split_part({h}, '.', {k}) AS BIGINT)" for k in (1, 2, 3, 4)]
    return f"CASE WHEN regexp_matches({h}, '^{one}(\\.{one}){{3}}$') THEN {p[0]} * 16777216 + {p[1]} * 65536 + {p[2]} * 256 + {p[3]} END"


def blocked(h: str) -> str:
    ranges = []
    for base, bits in V.PRIVATE_RANGES:
        a, b, c, d = map(int, base.split("."))
        n = ((a * 256 + b) * 256 + c) * 256 + d
        ranges.append(f"({ip(h)}) BETWEEN {n} AND {n + 2 ** (32 - bits) - 1}")
    return (
        f"({h} IN {names(V.LOCAL_HOSTS)} OR {h} LIKE '%.localhost' OR {h} LIKE '%.local' OR {h} LIKE '%.internal' OR {h} NOT LIKE '%.%' OR {h} LIKE '[%'"
        f" OR regexp_matches({h}, '^0x[0-9a-f]+$') OR regexp_matches({h}, '^[0-9]+$') OR coalesce({' OR '.join(ranges)}, false))"
    )


def public(u: str, http: bool) -> str:
    scheme, port = f"lower({part(u, 1)})", f"regexp_extract({part(u, 2)}, ':([0-9]*)$', 1)"
    schemes = "('https', 'http')" if http else "('https')"
    good = (
        f"{scheme} IN {schemes} AND {part(u, 2)} NOT LIKE '%@%' AND ({port} = '' OR ({port} = '443' AND {scheme} = 'https') OR ({port} = '80' AND {scheme} = 'http'))"
        f" AND NOT {blocked(host(u))} AND NOT regexp_matches({u}, '[\\s|]')"
    )
    return f"CASE WHEN {good} THEN {scheme} || '://' || {host(u)} || CASE WHEN {part(u, 3)} = '' THEN '/' ELSE {part(u, 3)} END || {part(u, 4)} ELSE '' END"


def last_labels(h: str, suffixes) -> str:
    p = f"string_split({h}, '.')"
    two = f"array_to_string(list_slice({p}, -2, -1), '.')"
    return f"CASE WHEN len({p}) <= 2 THEN {h} WHEN {two} IN {names(suffixes)} THEN array_to_string(list_slice({p}, -3, -1), '.') ELSE {two} END"


def owner(d: str) -> str:
    return f"regexp_replace(regexp_replace(regexp_replace(trim(lower({d})), '^.*@', ''), ':[^:]*$', ''), '^www\\.', '')"


def hint(c: str) -> str:
    return f"CASE WHEN length({strip(c)}) <= 250 THEN {strip(c)} ELSE regexp_replace(substring({strip(c)}, 1, 250), '{WS}+{NWS}*$', '') || '…' END"


def count_all(c: str, pattern: str) -> str:
    return f"CAST(len(regexp_extract_all({c}, '{pattern}')) AS BIGINT)"


def html(c: str) -> str:
    for tag in V.DROPPED_TAGS:
        c = f"regexp_replace({c}, '(?is)<{tag}[^>]*>.*?</{tag}>', ' ', 'g')"
    c = f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"
    for entity, sign in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#039;", "''"), ("&nbsp;", " ")):
        c = f"replace({c}, '{entity}', '{sign}')"
    return f"regexp_replace(regexp_replace({c}, '[ \\t\\r\\n]{{2,}}', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g')"


def grams(c: str, n: int = 8) -> str:
    words = f"regexp_extract_all(regexp_replace(lower({c}), '[^a-z0-9_\\t\\n\\x0B\\f\\r \\x{{a0}}\\x{{feff}}{CJK}]', '', 'g'), '{TOKEN}')"
    return words, n


def title_words(c: str) -> str:
    return f"list_filter(string_split(trim(regexp_replace(lower({strip(c)}), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) > 2 AND w NOT IN {names(V.TITLE_STOPWORDS)})"


PAGE_URLS = f"(SELECT url FROM pages UNION ALL SELECT url FROM {table(Q.URLS, 'url')})"
PAGE_ITEMS = f"""(SELECT page_id AS arrival, regexp_extract({part('url', 3)}, '^/([a-z]+)/', 1) AS topic, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, url,
  {domain('url')} AS source_domain, CASE WHEN page_id % 3 = 0 THEN 'primary' ELSE 'news' END AS tier, epoch_ms((1709294096 - page_id * 600) * 1000) AS published_at, page_id % 7 AS feed_rank FROM pages)"""
DOC_ITEMS = r"""(SELECT doc_id, lang AS topic, array_to_string(list_slice(string_split_regex(text, '[\t\n\x0B\f\r ]+'), 1, 12), ' ') AS title, source, source || '.example.com' AS source_domain, text FROM documents)"""
ORDERED = f"(SELECT *, row_number() OVER (PARTITION BY topic ORDER BY feed_rank, published_at DESC, arrival) - 1 AS ord, list_distinct({title_words('title')}) AS tokens FROM {PAGE_ITEMS})"
EDGES = f"""(SELECT a.topic, a.ord AS i, b.ord AS j, CAST(len(list_intersect(a.tokens, b.tokens)) AS BIGINT) AS overlap,
    CAST(len(list_filter(list_intersect(a.tokens, b.tokens), lambda w: w IN {names(V.IMPORTANT_TOKENS)})) AS BIGINT) AS weighted,
    (len(list_intersect(a.tokens, b.tokens)) + 1.5::DOUBLE * len(list_filter(list_intersect(a.tokens, b.tokens), lambda w: w IN {names(V.IMPORTANT_TOKENS)}))) / least(len(a.tokens), len(b.tokens))::DOUBLE AS sim
  FROM o a JOIN o b ON a.topic = b.topic AND a.ord < b.ord WHERE len(a.tokens) > 0 AND len(b.tokens) > 0)"""
# Greedy leaders one by one: an item leads unless an earlier leader is among its neighbours.
CLUSTERS = f"""WITH RECURSIVE o AS MATERIALIZED {ORDERED}, e AS MATERIALIZED (SELECT * FROM {EDGES} WHERE sim >= 0.82),
  n AS MATERIALIZED (SELECT o.topic, o.ord, list(e.i) FILTER (WHERE e.i IS NOT NULL) AS before FROM o LEFT JOIN e ON e.topic = o.topic AND e.j = o.ord GROUP BY ALL),
  g AS (SELECT topic, -1::BIGINT AS ord, []::BIGINT[] AS leaders, NULL::BIGINT AS leader FROM (SELECT DISTINCT topic FROM o)
    UNION ALL SELECT n.topic, n.ord, CASE WHEN len(list_intersect(coalesce(n.before, []), g.leaders)) > 0 THEN g.leaders ELSE list_append(g.leaders, n.ord) END,
      coalesce(list_min(list_intersect(coalesce(n.before, []), g.leaders)), n.ord) FROM g JOIN n ON n.topic = g.topic AND n.ord = g.ord + 1),
  c AS (SELECT o.*, g.leader, 'cluster-' || o.topic || '-' || (dense_rank() OVER (PARTITION BY o.topic ORDER BY g.leader) - 1) AS cluster_id,
      o.topic || '-' || substring(sha256({norm('o.title')} || '|' || {path_key('o.url')}), 1, 32) AS id FROM o JOIN g ON g.topic = o.topic AND g.ord = o.ord)"""
_GW, _GN = grams("text")
GRAMS = "SELECT id, array_to_string(list_slice(w, k, k + 7), ' ') AS gram FROM (SELECT id, w, unnest(range(1, len(w) - 6)) AS k FROM (SELECT {id} AS id, {w} AS w FROM {t}) WHERE len(w) >= 8)"
_FACT_EXTRA = "(VALUES (-1, 'Microsoft said that Kubernetes clusters grew by 45 percent in the last year. After that the New York Times wrote about 1.5 million users there.'), (-2, 'revenue rose to 3,000 GB of data in the week. Nothing else of note was written in lower case words.')) t(doc_id, text)"

_ORG = "(?i)\\b(" + "|".join(V.ORGANISATIONS) + ")\\b"
_NAME = "\\b([A-Z][a-z]+(?:" + WS + "+[A-Z][a-z]+){0,3})\\b"
_NUMBER = "(?i)\\b[0-9][0-9,.]*" + WS + "*(?:" + "|".join(V.UNITS) + ")\\b"
# Sentence ends are marked, as the regular expressions here have no lookbehind.
FACT_DOCS = f"""SELECT 'ai' AS topic, 'cluster-ai-' || ((doc_id % 50 + 50) % 50) AS cluster_id, CAST(doc_id AS VARCHAR) AS doc_id, 's' || ((doc_id % 3 + 3) % 3) || '.example.com' AS source_domain, 'https://e.example.com/' || doc_id AS url, text AS body
    FROM (SELECT doc_id, text FROM documents UNION ALL SELECT * FROM {_FACT_EXTRA})"""
# Facts of the documents d (topic, cluster_id, doc_id, source_domain, url, body).
MINED = f"""ml AS (SELECT *, list_slice(list_filter(string_split(regexp_replace(body, '([.!?]){WS}+', '\\1' || chr(1), 'g'), chr(1)), lambda x: length(x) > 30 AND length(x) < 500), 1, 20) AS ss FROM d),
  ms AS (SELECT * EXCLUDE (ss, body), unnest(ss) AS s, generate_subscripts(ss, 1) AS pos FROM ml),
  me AS (SELECT *, regexp_extract_all(s, '{_ORG}') AS orgs, regexp_extract_all(s, '{_NUMBER}') AS numbers, regexp_extract_all(s, '{_NAME}') AS caps FROM ms),
  mf AS (SELECT *, list_concat(orgs, list_filter(caps, lambda x: length(x) > 3 AND x NOT IN {names(V.NO_NAMES)} AND NOT list_contains(list_transform(orgs, lambda o: lower(o)), lower(x)))) AS found FROM me),
  mw AS (SELECT *, coalesce(found[1], topic) AS prim, array_to_string(list_slice(list_filter(string_split_regex(regexp_replace(lower(s), '[^a-z0-9\\t\\n\\x0B\\f\\r ]', ' ', 'g'), '[\\t\\n\\x0B\\f\\r ]+'),
    lambda x: length(x) >= 3 AND x NOT IN {names(V.STATEMENT_STOPWORDS)}), 1, 6), ' ') AS content FROM mf WHERE len(found) > 0 OR len(numbers) > 0),
  mt AS (SELECT *, substring(trim(regexp_replace(concat_ws(' ', prim, content), '{WS}+', ' ', 'g')), 1, 120) AS statement FROM mw),
  mu AS (SELECT * FROM mt QUALIFY row_number() OVER (PARTITION BY cluster_id, doc_id, lower(statement) ORDER BY pos) = 1),
  mv AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster_id, doc_id ORDER BY pos) AS INT) AS nth, try_cast(regexp_extract(regexp_replace(numbers[1], '[^0-9.]', '', 'g'), '^[0-9]*[.]?[0-9]+') AS DOUBLE) AS value,
    regexp_extract_all(s, '{NWS}+') AS qw FROM mu),
  facts AS (SELECT substring(sha256(concat_ws('|', cluster_id, statement, doc_id)), 1, 32) AS id, *, list_slice(list_distinct_in_order, 1, 8) AS entities, array_to_string(list_slice(qw, 1, 20), ' ') || CASE WHEN len(qw) > 20 THEN '…' ELSE '' END AS quote
    FROM (SELECT *, list_filter(found, lambda x, i: list_position(found, x) = i) AS list_distinct_in_order FROM mv) WHERE nth <= 8)"""
FACTS = f"WITH d AS ({FACT_DOCS}), {MINED}"
OWNERS = f"""owners AS (SELECT cluster_id, count(DISTINCT {last_labels("regexp_replace(lower(source_domain), '^www[.]', '')", V.CORROBORATION_SUFFIXES)}) AS n FROM d GROUP BY 1)"""
_CLOSED = f"""domain IN {names(V.CLOSED_DOMAINS)} OR regexp_matches(html, '(?i)isAccessibleForFree["''\\s]*:\\s*["'']?false') OR regexp_matches(html, '(?i)og:article:access["''\\s]*content=["'']subscriber')
          OR {' OR '.join(f"contains(lower(html), '{a}=\"{m}\"')" for m in V.PAYWALL_MARKS for a in ('class', 'id'))} OR length(t) < 200"""
_SAFE = public("trim(url)", False)
_CANON = f"lower({part('url', 1)}) || '://' || {host('url')} || CASE WHEN {part('url', 3)} = '' THEN '/' ELSE {part('url', 3)} END"
# The article part of a cycle: what the budget covers, where bodies come from, and the documents d that may be mined.
ETL = f"""{CLUSTERS}, i AS MATERIALIZED (SELECT arrival, topic, title, source_domain, cluster_id, ord, CAST(regexp_extract(cluster_id, '([0-9]+)$', 1) AS BIGINT) AS n,
      CASE WHEN arrival % 11 = 0 THEN 'https://news.google.com/rss/' || arrival ELSE url END AS url, CASE WHEN arrival % 22 = 0 THEN repeat(title, 4) ELSE '' END AS hint,
      CASE WHEN arrival % 3 = 1 THEN repeat(title || ' OpenAI said that it grew by 45 percent there. ', arrival % 12) END AS feed_body FROM c),
    pg AS MATERIALIZED (SELECT page_id, url, CASE WHEN page_id % 17 = 0 THEN NULL ELSE html END AS html, page_id % 13 <> 0 AS allowed FROM pages),
    st AS (SELECT substring(sha256(url), 1, 40) AS id, page_id, sha256(url) AS content_hash, repeat(url || ' Stored by Reader Two for 9 million. ', 3) AS body FROM pg WHERE page_id % 7 = 0 AND page_id % 2 = 1),
    u1 AS (SELECT * FROM i QUALIFY row_number() OVER (PARTITION BY topic, n, url ORDER BY ord) = 1),
    b AS MATERIALIZED (SELECT * FROM u1 QUALIFY row_number() OVER (PARTITION BY topic ORDER BY n, ord) <= {V.BUDGET}),
    r AS MATERIALIZED (SELECT b.*, st.id AS s_id, st.page_id, st.content_hash AS s_hash, st.body AS s_body,
      CASE WHEN st.id IS NOT NULL THEN 'store' WHEN length(b.feed_body) >= 100 THEN 'feed' WHEN {host('b.url')} = 'news.google.com' THEN CASE WHEN length(trim(hint)) >= 50 THEN 'hint' ELSE 'none' END ELSE 'fetch' END AS origin
      FROM b LEFT JOIN st ON st.id = substring(sha256(b.url), 1, 40)),
    p1 AS MATERIALIZED (SELECT r.*, pg.html, coalesce(pg.allowed, true) AS allowed, {_SAFE.replace('url', 'r.url')} AS safe, {html('pg.html')} AS t FROM r LEFT JOIN pg ON pg.url = r.url WHERE origin = 'fetch'),
    p2 AS (SELECT *, {domain("CASE WHEN safe = '' THEN url ELSE safe END")} AS domain FROM p1),
    p3 AS (SELECT *, CASE WHEN safe = '' THEN 'tos-restricted' WHEN NOT allowed THEN 'robots-disallowed' WHEN html IS NULL THEN 'allowed' WHEN {_CLOSED} THEN 'paywalled' ELSE 'allowed' END AS policy,
      list_filter(list_transform(string_split_regex(t, '\\n{{2,}}|{WS}{{4,}}'), lambda p: trim(p)), lambda p: length(p) > 80) AS ps FROM p2),
    p4 AS (SELECT *, html IS NULL OR policy IN ('robots-disallowed', 'tos-restricted') AS failed, CASE WHEN policy = 'paywalled' THEN substring(t, 1, 500) WHEN len(ps) > 0 THEN array_to_string(ps, chr(10) || chr(10)) ELSE trim(substring(t, 1, 500)) END AS body FROM p3),
    p5 AS (SELECT *, CASE WHEN policy = 'paywalled' THEN CAST(len(string_split_regex(body, '{WS}+')) AS BIGINT) ELSE {count_all('body', NWS + '+')} END AS words, CASE WHEN failed THEN {_CANON.replace('url', "(CASE WHEN safe = '' THEN url ELSE safe END)")} ELSE safe END AS address FROM p4),
    docs AS MATERIALIZED (
      SELECT topic, cluster_id, s_id AS id, url, source_domain, 'full' AS extraction, 'allowed' AS access_policy, page_id AS word_count, 'en' AS lang, s_hash AS content_hash, s_body AS body, origin FROM r WHERE origin = 'store'
      UNION ALL SELECT topic, cluster_id, substring(sha256(url), 1, 40), url, source_domain, CASE WHEN length(feed_body) >= 500 THEN 'full' ELSE 'snippet' END, 'allowed', {count_all('feed_body', NWS + '+')}, 'en', sha256(feed_body), feed_body, origin FROM r WHERE origin = 'feed'
      UNION ALL SELECT topic, cluster_id, substring(sha256(url), 1, 40), url, source_domain, 'snippet', 'allowed', {count_all('trim(hint)', NWS + '+')}, 'en', sha256(trim(hint)), trim(hint), origin FROM r WHERE origin = 'hint'
      UNION ALL SELECT topic, cluster_id, substring(sha256(address), 1, 40), address, source_domain, CASE WHEN failed THEN 'failed' WHEN policy = 'paywalled' OR words <= 50 THEN 'snippet' ELSE 'full' END, policy, CASE WHEN NOT failed THEN words END,
        CASE WHEN NOT failed THEN nullif(lower(regexp_extract(html, '(?i)<html[^>]+lang=["'']([a-zA-Z]+)[a-zA-Z-]*["'']', 1)), '') END, sha256(CASE WHEN failed THEN '' ELSE body END), CASE WHEN NOT failed THEN body END, origin FROM p5),
    d AS MATERIALIZED (SELECT topic, cluster_id, id AS doc_id, source_domain, url, body FROM docs WHERE extraction <> 'failed' AND access_policy = 'allowed' AND length(body) >= 100 QUALIFY row_number() OVER (PARTITION BY cluster_id, id ORDER BY url, content_hash) = 1)"""
_GRAM_LIST = lambda c: f"list_transform(range(1, len({grams(c)[0]}) - 6), lambda k: array_to_string(list_slice({grams(c)[0]}, k, k + 7), ' '))"
ORACLE: dict[str, str] = {
    "fact_rows": f"""{FACTS}, {OWNERS}
        SELECT id, cluster_id, doc_id, nth, statement, array_to_string(entities, '|') AS entities, quote, CASE WHEN value IS NOT NULL THEN prim END AS metric, value, greatest(n, 1) AS corroboration, CASE WHEN n >= 2 THEN 'medium' ELSE 'low' END AS confidence FROM facts JOIN owners USING (cluster_id)""",
    "wire_guard": f"""{FACTS}, n AS (SELECT *, CAST('0x' || substring(id, 1, 4) AS INT) AS n FROM facts)
        SELECT CASE WHEN n % 11 = 0 THEN 'provenance' WHEN n % 7 = 0 THEN 'verbatim' WHEN n % 5 = 0 THEN 'url' WHEN n % 3 = 0 THEN 'quote' ELSE 'clean' END AS violation, count(*) AS n FROM n GROUP BY 1""",
    "etl_documents": f"{ETL} SELECT topic, cluster_id, id, url, source_domain, extraction, access_policy, word_count, lang, content_hash FROM docs",
    "etl_bodies": f"{ETL} SELECT cluster_id, id, origin, CAST(length(body) AS BIGINT) AS n, md5(body) AS body_md5 FROM docs",
    "etl_facts": f"""{ETL}, {MINED}, {OWNERS}
        SELECT id, topic, cluster_id, doc_id, nth, statement, array_to_string(entities, '|') AS entities, quote, CASE WHEN value IS NOT NULL THEN prim END AS metric, value, greatest(n, 1) AS corroboration, CASE WHEN n >= 2 THEN 'medium' ELSE 'low' END AS confidence
        FROM facts JOIN owners USING (cluster_id) JOIN (SELECT cluster_id, doc_id, body FROM d) x USING (cluster_id, doc_id) WHERE NOT list_has_any({_GRAM_LIST('statement')}, {_GRAM_LIST('x.body')})""",
    "etl_guard": f"""{ETL}, {MINED}, lifted AS (SELECT id, cluster_id, doc_id, body, CASE WHEN CAST('0x' || substring(id, 1, 4) AS INT) % 3 = 0 THEN regexp_replace(quote, '…$', '') ELSE statement END AS said FROM facts JOIN (SELECT cluster_id, doc_id, body FROM d) USING (cluster_id, doc_id))
        SELECT id, cluster_id, doc_id, CASE WHEN list_has_any({_GRAM_LIST('said')}, {_GRAM_LIST('body')}) THEN 'verbatim' END AS violation FROM lifted""",
    "etl_warnings": f"""{ETL}, {MINED}, w0 AS (SELECT topic, cluster_id, count(*) AS members, count(DISTINCT url) AS urls FROM i GROUP BY ALL), w1 AS (SELECT cluster_id, count(*) AS k FROM b GROUP BY 1),
        w AS (SELECT topic, cluster_id, 'budget' AS kind FROM w0 LEFT JOIN w1 USING (cluster_id) WHERE coalesce(k, 0) < urls UNION ALL SELECT topic, cluster_id, 'search' FROM r WHERE origin = 'none'
          UNION ALL SELECT topic, cluster_id, CASE WHEN access_policy = 'robots-disallowed' THEN 'robots' WHEN access_policy = 'paywalled' THEN 'paywall' ELSE 'fetch' END FROM docs WHERE extraction = 'failed' OR (access_policy = 'paywalled' AND origin = 'fetch')
          UNION ALL SELECT topic, cluster_id, 'empty' FROM w0 WHERE cluster_id NOT IN (SELECT cluster_id FROM d) UNION ALL SELECT DISTINCT topic, cluster_id, 'provider' FROM d
          UNION ALL SELECT topic, cluster_id, 'A5' FROM facts JOIN (SELECT cluster_id, doc_id, body FROM d) x USING (cluster_id, doc_id) WHERE list_has_any({_GRAM_LIST('statement')}, {_GRAM_LIST('x.body')}))
        SELECT topic, cluster_id, kind, count(*) AS n FROM w GROUP BY ALL""",
    "artifact_all": f"""{CLUSTERS}, m AS (SELECT cluster_id, count(DISTINCT source_domain) AS mentions FROM c GROUP BY 1), f AS (SELECT c.id, c.topic, mentions, c.cluster_id, ord FROM c JOIN m USING (cluster_id) QUALIFY row_number() OVER (PARTITION BY c.id ORDER BY mentions DESC, c.topic, ord) = 1)
        SELECT row_number() OVER (ORDER BY mentions DESC, topic, ord) - 1 AS pos, id, topic, mentions, cluster_id FROM f""",
    "strip_markup": f"SELECT doc_id, CAST(length({strip('text')}) AS BIGINT) AS n, md5({strip('text')}) AS stripped_md5, md5({norm('text')}) AS norm_md5 FROM documents",
    "fingerprint_ids": f"""SELECT arrival AS page_id, fp, topic || '-' || substring(sha256(fp), 1, 32) AS item_id, substring(sha256(url), 1, 40) AS doc_id
        FROM (SELECT *, {norm('title')} || '|' || {path_key('url')} AS fp FROM {PAGE_ITEMS})""",
    "split_title": f"""WITH d AS (SELECT doc_id, text, {strip("title || CASE WHEN doc_id % 2 = 0 THEN ' - ' || source ELSE '' END")} AS t, CASE WHEN doc_id % 3 = 0 THEN 'Label' END AS label FROM {DOC_ITEMS}),
        s AS (SELECT *, regexp_extract(t, '^(.*?){WS}+-{WS}+([^-]{{2,60}})$', 2) AS suffix FROM d)
        SELECT doc_id, CASE WHEN suffix <> '' THEN regexp_extract(t, '^(.*?){WS}+-{WS}+([^-]{{2,60}})$', 1) ELSE t END AS title, coalesce(label, nullif(suffix, ''), 'News source') AS source_name, {hint('text')} AS hint FROM s""",
    "url_normalize": f"SELECT url, {public('trim(url)', False)} AS https_only, {public('trim(url)', True)} AS http_too, {path_key('url')} AS path_key, {domain('url')} AS domain FROM {PAGE_URLS}",
    "owner_domains": f"""SELECT h, {last_labels(owner('h'), V.COVERAGE_SUFFIXES)} AS owner_a, {last_labels("regexp_replace(lower(h), '^www[.]', '')", V.CORROBORATION_SUFFIXES)} AS owner_b
        FROM (SELECT DISTINCT {host('url')} AS h FROM {PAGE_URLS})""",
    "blocked_hosts": f"""WITH c AS (SELECT (client_id * 2654435761) % 4294967296 AS ip FROM clients),
        h AS (SELECT {host('url')} AS h FROM pages UNION SELECT (ip >> 24) || '.' || ((ip >> 16) & 255) || '.' || ((ip >> 8) & 255) || '.' || (ip & 255) FROM c UNION SELECT h FROM {table(Q.HOSTS, 'h')}) SELECT h, {blocked('h')} AS blocked FROM h""",
    "content_hash": "SELECT sha256(text) AS content_hash, min(doc_id) AS first_id, count(*) AS n FROM documents GROUP BY 1",
    "html_text": f"""WITH t AS MATERIALIZED (SELECT page_id, html, {html('html')} AS t FROM pages),
        b AS (SELECT *, list_filter(list_transform(string_split_regex(t, '\\n{{2,}}|{WS}{{4,}}'), lambda p: trim(p)), lambda p: length(p) > 80) AS p FROM t),
        c AS (SELECT *, CASE WHEN len(p) > 0 THEN array_to_string(p, chr(10) || chr(10)) ELSE trim(substring(t, 1, 500)) END AS body FROM b)
        SELECT page_id, CAST(length(t) AS BIGINT) AS n, md5(t) AS text_md5, nullif(lower(regexp_extract(html, '(?i)<html[^>]+lang=["'']([a-zA-Z]+)[a-zA-Z-]*["'']', 1)), '') AS lang,
          {count_all('body', NWS + '+')} AS words, CASE WHEN {count_all('body', NWS + '+')} > 50 THEN 'full' ELSE 'snippet' END AS extraction FROM c""",
    "paywall_flag": f"""WITH p AS (SELECT 'page' || page_id AS id, {domain('url')} AS domain, html FROM pages UNION ALL SELECT * FROM {table(Q.PAGES, 'id, domain, html')})
        SELECT id, domain IN {names(V.CLOSED_DOMAINS)} OR regexp_matches(html, '(?i)isAccessibleForFree["''\\s]*:\\s*["'']?false') OR regexp_matches(html, '(?i)og:article:access["''\\s]*content=["'']subscriber')
          OR {' OR '.join(f"contains(lower(html), '{a}=\"{m}\"')" for m in V.PAYWALL_MARKS for a in ('class', 'id'))} OR length({html('html')}) < 200 AS paywalled FROM p""",
    "cjk_word_count": f"""WITH c AS (SELECT DISTINCT text FROM conversations UNION ALL SELECT * FROM {table(Q.QUOTES, 'text')}), t AS (SELECT text, regexp_extract_all(text, '{TOKEN}') AS w FROM c)
        SELECT md5(text) AS k, CAST(len(w) AS BIGINT) AS n, {count_all('text', NWS + '+')} AS n_space, CASE WHEN len(w) <= 25 THEN text ELSE array_to_string(list_slice(w, 1, 25), ' ') || '…' END AS quote FROM t""",
    "dedup_first_wins": "SELECT sha256(text) AS h, source, doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY sha256(text), source ORDER BY doc_id) = 1",
    "duplicates_removed": "SELECT count(*) AS n_rows, count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS removed FROM documents",
    "cycle_window_counts": "SELECT strftime(time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS cycle_start, event_type, count(*) AS n, count(*) / 6.0::DOUBLE AS velocity FROM events GROUP BY ALL",
    "metric_key_screen": f"""WITH k AS (SELECT DISTINCT event_type AS key FROM events UNION ALL SELECT * FROM (VALUES ('userId'), ('user_id'), ('session_token'), ('share_count'), ('Like'), ('hearts'), ('e-mail address'), ('Comment Count'), ('count')) t(key)),
        n AS (SELECT key, regexp_replace(lower(key), '[-_\\s]', '', 'g') AS x FROM k), f AS (SELECT *, {' OR '.join(f"contains(x, '{w}')" for w in V.FORBIDDEN_FRAGMENTS)} AS forbidden FROM n)
        SELECT key, forbidden, CASE WHEN forbidden THEN NULL {' '.join(f"WHEN x IN {names(v)} THEN '{m}'" for m, v in V.METRICS.items())} END AS metric FROM f""",
    "topic_coverage": f"""WITH i AS {DOC_ITEMS}, s AS (SELECT topic, source, count(*) >= 3 AS ok FROM i GROUP BY ALL), a AS (SELECT topic, count(*) AS configured, count(*) AS queried, count(*) FILTER (WHERE ok) AS responded FROM s GROUP BY 1),
        d AS (SELECT topic, count(DISTINCT {last_labels(owner('source_domain'), V.COVERAGE_SUFFIXES)}) AS n FROM i GROUP BY 1)
        SELECT topic, configured, queried, responded, n AS distinct_domains, n < {Q.FLOOR} AS degraded FROM a JOIN d USING (topic)""",
    "global_coverage": f"""WITH i AS {DOC_ITEMS}, s AS (SELECT topic, source, count(*) >= 3 AS ok FROM i GROUP BY ALL)
        SELECT count(*) AS configured, count(*) AS queried, count(*) FILTER (WHERE ok) AS responded, (SELECT count(DISTINCT {last_labels(owner('source_domain'), V.COVERAGE_SUFFIXES)}) FROM i) AS distinct_domains, false AS degraded FROM s""",
    "claims": f"""SELECT doc_id, array_to_string(list_slice(list_filter({array(V.CLAIM_ENTITIES + ('ere', 'tion', 'ment', 'ci/cd', 'ando'))}, lambda t: contains(lower(title || ' ' || substring(text, 1, 250)), t)), 1, 5), ',') AS claims FROM {DOC_ITEMS}""",
    "title_similarity_edges": f"WITH o AS MATERIALIZED {ORDERED} SELECT topic, i, j, overlap, weighted, sim FROM {EDGES} WHERE sim >= 0.82",
    "title_classes": f"""WITH o AS MATERIALIZED {ORDERED}, e AS MATERIALIZED (SELECT topic, i, j FROM {EDGES} WHERE sim >= 0.82), n AS (SELECT topic, ord, count(*) AS links FROM (SELECT topic, i AS ord FROM e UNION ALL SELECT topic, j FROM e) GROUP BY ALL),
        k AS (SELECT topic, ord, min(ord) OVER w AS class, count(*) OVER w AS size FROM (SELECT *, CASE WHEN len(tokens) > 0 THEN array_to_string(list_sort(tokens), ' ') ELSE '/' || ord END AS s FROM o) WINDOW w AS (PARTITION BY topic, s))
        SELECT topic, ord, class, size, coalesce(links, 0) AS links FROM k LEFT JOIN n USING (topic, ord)""",
    "leader_clusters": f"{CLUSTERS} SELECT arrival AS page_id, topic, ord, leader, cluster_id FROM c",
    "cluster_rollup": f"""{CLUSTERS}, t AS (SELECT topic, cluster_id, string_agg(tier || ':' || n, ',' ORDER BY tier) AS tiers FROM (SELECT topic, cluster_id, tier, count(*) AS n FROM c GROUP BY ALL) GROUP BY ALL)
        SELECT topic, cluster_id, count(*) AS members, count(DISTINCT source_domain) AS source_count, count(DISTINCT source_domain) AS distinct_domains, strftime(min(published_at), '%Y-%m-%d %H:%M:%S') AS earliest,
          strftime(max(published_at), '%Y-%m-%d %H:%M:%S') AS latest, string_agg(id, ',' ORDER BY ord) AS member_ids, any_value(tiers) AS tiers FROM c JOIN t USING (topic, cluster_id) GROUP BY ALL""",
    "cluster_projection": f"{CLUSTERS}, m AS (SELECT topic, cluster_id, count(DISTINCT source_domain) AS mentions, count(*) / 6.0::DOUBLE AS velocity FROM c GROUP BY ALL) SELECT arrival AS page_id, cluster_id, mentions, velocity FROM c JOIN m USING (topic, cluster_id)",
    "verbatim_overlap": f"SELECT DISTINCT id AS doc_id FROM ({GRAMS.format(id='doc_id', w=_GW, t='documents')}) WHERE gram IN (SELECT gram FROM ({GRAMS.format(id='item_id', w=_GW, t='benchmark')}))",
    "fetch_budget": f"""WITH d AS (SELECT lang AS topic, doc_id % 17 AS cluster_ord, doc_id AS member_ord FROM documents QUALIFY row_number() OVER (PARTITION BY lang, doc_id % 17, sha256(text) ORDER BY doc_id) = 1)
        SELECT *, row_number() OVER (PARTITION BY topic ORDER BY cluster_ord, member_ord) AS nth FROM d QUALIFY nth <= {V.BUDGET}""",
    "new_urls": f"""WITH f AS (SELECT {public('trim(url)', True)} AS url, page_id % 2 AS provider_ord, page_id AS ord FROM pages UNION ALL SELECT {public('trim(url)', True)}, 5, page_id FROM pages)
        SELECT url, provider_ord, ord, 9999::BIGINT AS feed_rank FROM f WHERE url <> '' AND url NOT IN (SELECT {public('trim(url)', True)} FROM pages WHERE starts_with({part('url', 3)}, '/de/')) QUALIFY row_number() OVER (PARTITION BY url ORDER BY provider_ord, ord) = 1""",
    "new_domains": f"""WITH d AS (SELECT DISTINCT {domain('url')} AS domain FROM pages UNION ALL SELECT * FROM (VALUES ('arxiv.org'), ('openai.com'), ('infoq.com'), ('threatpost.com'), ('www.arxiv.org')) t(domain))
        SELECT domain, CASE {' '.join(f"WHEN domain IN {names(d)} THEN '{t}'" for t, _, d in V.KNOWN_DOMAINS)} ELSE 'news' END AS tier, CAST(CASE {' '.join(f"WHEN domain IN {names(d)} THEN {c}" for _, c, d in V.KNOWN_DOMAINS)} ELSE 0.6 END AS DOUBLE) AS credibility
        FROM d WHERE domain NOT IN (SELECT {domain('url')} FROM pages WHERE starts_with({part('url', 3)}, '/es/'))""",
    "global_merge_topk": """WITH d AS (SELECT sha256(text) AS id, lang AS topic, length(text) % 97 AS mentions, list_position(['de', 'en', 'es', 'fr'], lang) AS topic_ord, doc_id AS item_ord FROM documents),
        f AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY id ORDER BY mentions DESC, topic_ord, item_ord) = 1) SELECT id, mentions, topic, item_ord FROM f ORDER BY mentions DESC, topic_ord, item_ord LIMIT 100""",
    "robots_longest_prefix": f"""WITH r AS (SELECT * FROM (VALUES ('thther.example.org', 'disallow', '/en/'), ('thther.example.org', 'allow', '/en/7'), ('ththble.example.net', 'disallow', '/es/')) t(host, kind, prefix)),
        u AS (SELECT page_id, {host('url')} AS host, {part('url', 3)} AS path FROM pages)
        SELECT page_id, u.host, coalesce(arg_max(kind = 'allow', length(prefix) * 2 + CAST(kind = 'disallow' AS INT)), true) AS allowed FROM u LEFT JOIN r ON r.host = u.host AND starts_with(u.path, r.prefix) GROUP BY page_id, u.host""",
    "catalog_topics": f"""WITH c AS (SELECT * FROM {table(Q.CATALOG, 'name, owner, category, tier, source_type, url, type, verified, checked')} UNION ALL SELECT name, 'o', {array(tuple(V.CATEGORY_TOPICS) + ('Other',))}[vendor_id % {len(V.CATEGORY_TOPICS) + 1} + 1], vendor_id % 3 + 1,
          ['blog', 'press', 'preprint', 'press', 'blog'][vendor_id % 5 + 1], 'https://www.v' || vendor_id || '.example.com/feed', ['RSS', 'Atom', 'JSON', 'RSS'][vendor_id % 4 + 1], vendor_id % 7 <> 0, NULL FROM vendors WHERE vendor_id IS NOT NULL), t AS (SELECT * FROM {table([(x[0], x[1]) for x in V.TOPICS], 'topic, label')}),
        s AS (SELECT coalesce(nullif({domain('url')}, ''), substring(url, 1, 80)) AS domain, name AS label, CASE WHEN source_type = 'preprint' THEN 'paper' WHEN tier = 1 THEN 'primary' WHEN category = 'Security/Vulnerabilities' THEN 'security-news'
            WHEN tier = 2 AND source_type <> 'press' THEN 'technical-news' ELSE 'news' END AS tier, 'rss' AS kind, CASE tier WHEN 1 THEN 0.9 WHEN 2 THEN 0.75 ELSE 0.65 END::DOUBLE AS credibility,
            CASE category {' '.join(f"WHEN {q(k)} THEN {array(v)}" for k, v in V.CATEGORY_TOPICS.items())} ELSE ['platform'] END AS topics
          FROM c WHERE coalesce(verified, true) AND url LIKE 'https://%' AND type <> 'JSON')
        SELECT topic, domain, label, tier, kind, credibility FROM (SELECT unnest(topics) AS topic, * EXCLUDE (topics) FROM s) WHERE topic <> 'all'
        UNION ALL SELECT topic, 'news.google.com', 'News search: ' || label, 'news', 'google-news-rss', 0.75::DOUBLE FROM t WHERE topic <> 'all'""",
    # what the two feeds by hand say: one entry is too old, one date unreadable; and the pages' feeds
    "rss_parse": f"""SELECT topic, title, source_name, source_domain, url, tier, published_at, summary_hint, feed_rank::INT AS feed_rank, feed_body, source FROM (VALUES
        ('ai', 'First story', 'Paper', 'a.example.com', 'https://a.example.com/1', 'news', '2024-03-01 10:00:00', 'Short', 0, trim(repeat('Body words here. ', 20)), 'rss1'),
        ('ai', 'Second', 'Wire', 'a.example.com', 'https://a.example.com/2', 'news', '2024-03-01 12:34:56', 'Second', 1, NULL, 'rss1'),
        ('ai', 'Atom one', 'News source', 'b.example.com', 'https://b.example.com/1', 'primary', '2024-03-01 09:00:00', 'Sum', 0, NULL, 'atom1'))
        t(topic, title, source_name, source_domain, url, tier, published_at, summary_hint, feed_rank, feed_body, source)
        UNION ALL SELECT 'ai', {strip('t')}, 'News source', coalesce(nullif({domain('u')}, ''), d), u, 'news', '2024-03-01 09:00:00', {hint('t')}, 0, CASE WHEN length({strip('t')}) >= {V.BODY_CHARS} THEN {strip('t')} END, 'page' || page_id
        FROM (SELECT page_id, replace(regexp_extract(html, '<title>([^<]*)</title>', 1), ' - ', ' ') AS t, {public('trim(url)', False)} AS u, {domain('url')} AS d FROM pages) WHERE u <> '' AND {strip('t')} <> ''""",
    "hermetic_artifact": f"""SELECT '{{"artifact": "aggregation", "contractRevision": 4, "cycle": {{"id": "2024-03-01T12:00:00.000Z", "windowEnd": "2024-03-01T18:00:00.000Z", "windowStart": "2024-03-01T12:00:00.000Z"}}, '
        || '"data": {{"clustersByTopic": {{}}, "coverageByTopic": {{}}, "itemsByTopic": {{}}}}, "generatedAt": "2024-03-01T12:34:56.000Z", "runId": "' || substring(sha256('lodestream:{Q.NOW}'), 1, 32)
        || '", "schemaVersion": "lodestream-content/v1", "topics": [' || (SELECT string_agg('{{"id": "' || id || '", "label": "' || label || '"}}', ', ' ORDER BY i) FROM {table([(x[0], x[1], i) for i, x in enumerate(V.TOPICS)], 'id, label, i')})
        || '], "upstreamRunId": null, "warnings": ["no network: empty artifact"]}}' AS artifact""",
    "error_codes": f"""WITH m AS (SELECT text AS message FROM conversations UNION SELECT 'parse of ' || raw FROM stamps UNION SELECT message FROM {table(Q.MESSAGES, 'message')}) SELECT md5(message) AS message_md5, CASE WHEN regexp_matches(message, '(?i)fetch|ECONNREFUSED|ENOTFOUND|timeout|ETIMEDOUT') THEN 'NETWORK_ERROR' WHEN regexp_matches(message, '(?i)JSON|parse|Unexpected token') THEN 'PARSE_ERROR' WHEN regexp_matches(message, 'schema|Schema') THEN 'SCHEMA_ERROR' ELSE 'UNKNOWN_ERROR' END AS code FROM m WHERE message IS NOT NULL""",
    "store_upsert": """WITH d AS (SELECT substring(sha256(source || '/' || doc_id), 1, 40) AS id, sha256(text) AS content_hash, n_chars AS words, doc_id AS arrival FROM documents)
        SELECT id, content_hash, words, arrival FROM d WHERE arrival % 2 = 0 AND arrival % 3 <> 0 AND arrival % 5 <> 0 UNION ALL
        SELECT id, content_hash, words + 1, arrival FROM d WHERE (arrival % 2 = 1 OR arrival % 3 = 0) AND arrival % 5 <> 0 UNION ALL SELECT id, content_hash, words + 2, arrival + 1000000 FROM d WHERE arrival % 5 = 0""",
    "store_lookup": "SELECT change_id, c.client_id IS NOT NULL AND c.segment IS NOT NULL AS hit FROM client_changes h LEFT JOIN clients c ON c.client_id = h.client_id",
    "store_by_hash": """WITH d AS (SELECT doc_id, sha256(text) AS h FROM documents), i AS (SELECT h, max(doc_id) AS doc_id FROM d GROUP BY h)
        SELECT substring(sha256(CAST(doc_id AS VARCHAR)), 1, 40) AS id, doc_id FROM i""",
    "store_freshness": f"""WITH e AS (SELECT event_id, ts, CASE WHEN event_id % 3 <> 0 THEN 'e' || event_id % 7 END AS etag, CASE WHEN event_id % 5 <> 0 THEN 'e' || event_id % 4 END AS known FROM events)
        SELECT event_id, CASE WHEN event_id % 11 = 0 THEN false WHEN coalesce(etag = known, false) THEN true WHEN event_id % 2 = 1 THEN epoch_ms(TIMESTAMP '2024-03-01 12:34:56') - epoch_ms(ts) < 432000000 ELSE true END AS fresh FROM e""",
    "interaction_metrics": f"""SELECT event_id, (user_id + 3)::DOUBLE AS shares, CASE WHEN regexp_replace(lower(event_type), '[-_\\s]', '', 'g') IN {names(V.METRICS['comments'])} THEN (user_id + 1)::DOUBLE END AS comments, (user_id + 2)::DOUBLE AS reactions FROM events""",
    "run_summary": f"{CLUSTERS} SELECT topic, count(*) AS items, count(DISTINCT cluster_id) AS clusters, count(DISTINCT source_domain) AS domains FROM c GROUP BY topic",
    "store_index": """WITH d AS (SELECT sha256(text) AS content_hash, doc_id, lang FROM documents) SELECT content_hash, CAST(min(doc_id) AS VARCHAR) AS id FROM d WHERE content_hash NOT IN (SELECT content_hash FROM d WHERE lang = 'en') GROUP BY 1""",
    "customers_without_orders": "SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)",
    "first_order_per_customer": "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
    "supplier_coverage": "SELECT o_orderpriority, count(DISTINCT l_suppkey) AS suppliers, count(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1",
}

ORACLE |= queries_state.ORACLE
ORACLE["feed_items"] = queries_state.FEED_ITEMS.format(
    host=host("url"), public=public("trim(x.url)", False), strip=strip("x.title"), domain=domain("url"), pages=queries_state.FEED_PAGES, most=queries_state.FEED_MOST
)
ORACLE["fetch_slots"] = queries_state.FETCH_SLOTS.format(host=host("url"), path=part("url", 3))
ORACLE["artifact_shards"] = queries_state.ARTIFACT_SHARDS.format(clusters=CLUSTERS, owner=last_labels(owner("source_domain"), V.COVERAGE_SUFFIXES))
