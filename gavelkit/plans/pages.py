"""Registered queries: landed pages and captured responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.operators import profiling as pf
from gavelkit.plans.adapters import spread_table, table
from gavelkit.plans.registry import Registry

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles

_NEEDLES = {"n_script": "<SCRIPT", "n_li": "<li>", "n_amp": "&amp;", "n_lot": '"lotNumber"', "n_dollar": "$$$"}


def _count_sql(needle: str) -> str:
    low = needle.lower()
    return f"CAST((length(h) - length(replace(h, '{low}', ''))) // {len(low)} AS BIGINT)"


@query(
    "WITH p AS (SELECT page_id, lower(html) AS h FROM pages) SELECT page_id, "
    + ", ".join(f"{_count_sql(n)} AS {c}" for c, n in _NEEDLES.items())
    + " FROM p"
)
def page_signal_counts(spark, sf_dir):
    rows = spread_table(spark, sf_dir, "pages").select("page_id", "html")
    return pf.signal_counts(rows, "html", _NEEDLES).drop("html")


_STATUS_SQL = "CASE WHEN page_id % 17 = 0 THEN 404 ELSE 200 END"
_BODY_SQL = "html || CASE WHEN page_id % 13 = 0 THEN ' Press & Hold ' WHEN page_id % 13 = 1 THEN ' Please verify you are human' ELSE '' END"


def _walled(spark, sf_dir):
    k = F.col("page_id") % 13
    extra = F.when(k == 0, " Press & Hold ").when(k == 1, " Please verify you are human").otherwise("")
    return spread_table(spark, sf_dir, "pages").select(
        "page_id", "url", F.when(F.col("page_id") % 17 == 0, 404).otherwise(200).alias("status"),
        F.concat("html", extra).alias("html"),
    )


@query(
    f"""
WITH p AS (SELECT page_id, {_STATUS_SQL} AS status, {_BODY_SQL} AS html FROM pages)
SELECT page_id, CASE WHEN contains(html, 'Press & Hold') THEN 'blocked' WHEN status >= 400 THEN 'http ' || status
                     WHEN length(html) < 5000 THEN 'small' ELSE 'real' END AS verdict,
       CASE WHEN contains(lower(html), 'verify you are human') THEN 'verify you are human' END AS wall FROM p"""
)
def page_verdict(spark, sf_dir):
    rows = _walled(spark, sf_dir)
    return rows.select(
        "page_id",
        pf.page_verdict(F.col("status"), F.col("html")).alias("verdict"),
        pf.wall_marker(F.col("html"), F.lit("")).alias("wall"),
    )


@query(
    """
SELECT page_id, contains(html, '__NEXT_DATA__') AS has_next_data, contains(html, '__NUXT__') AS has_nuxt_data,
       contains(html, 'application/ld+json') AS has_json_ld, contains(lower(html), 'algolia') AS mentions_search,
       regexp_matches(html, 'appId["\\s:]', 'i') AS mentions_app_id, CAST(NULL AS VARCHAR) AS app_id, CAST(NULL AS VARCHAR) AS index_name,
       CAST(len(regexp_extract_all(html, '\\$[\\d,]{2,7}(?:\\.\\d{2})?')) AS BIGINT) AS price_mentions,
       array_to_string(list_distinct(regexp_extract_all(html, '\\$[\\d,]{2,7}(?:\\.\\d{2})?'))[1:10], ' ') AS sample_prices,
       trim(regexp_extract(html, '(?i)<title>([^<]*)</title>', 1)) AS title FROM pages"""
)
def page_features(spark, sf_dir):
    out = spread_table(spark, sf_dir, "pages").select("page_id", *pf.page_features(F.col("html")))
    return out.withColumn("sample_prices", F.array_join("sample_prices", " "))


_KEYWORDS = ["consign", "marketplace", "the", "und"]


@query(
    f"""
WITH p AS (SELECT page_id, html || '<p>Sold by: Alpha & Sons</p><b>$1,234.50</b>' AS html FROM pages),
t AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(html, '(?i)<script[\\s\\S]*?</script>', '', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g') AS plain FROM p)
SELECT page_id, CAST(NULL AS VARCHAR) AS image, regexp_extract(html, '\\$[\\d,]+\\.\\d{{2}}', 0) AS price, substr(plain, 1, 400) AS snippet,
       array_to_string(list_filter({_KEYWORDS!r}, lambda k: contains(lower(plain), k)), ' ') AS keywords,
       regexp_extract(plain, '(?i)(sold by|seller:|consigned by)\\s*[:\\-]?\\s*([A-Z][\\w&.,'' -]{{2,40}})', 0) AS byline, CAST(NULL AS VARCHAR) AS vendor
FROM t"""
)
def product_page_facts(spark, sf_dir):
    html = F.concat(F.col("html"), F.lit("<p>Sold by: Alpha & Sons</p><b>$1,234.50</b>"))
    out = spread_table(spark, sf_dir, "pages").select("page_id", html.alias("html"))
    out = out.select("page_id", *pf.product_facts(F.col("html"), _KEYWORDS))
    return out.withColumn("keywords", F.array_join("keywords", " "))


_PHRASES = ["not be sold", "third part", "and the", "eau", "über"]


@query(
    f"""
SELECT doc_id, phrase, contains(lower(text), phrase) AS present FROM documents, (SELECT unnest({_PHRASES!r}) AS phrase)"""
)
def phrase_audit(spark, sf_dir):
    return pf.phrase_audit(spread_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", _PHRASES)


@query(
    """
WITH p AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS own,
                  regexp_extract(html, '(?i)<a\\b[^>]*?href=["'']([^"'']*)["''][^>]*>([\\s\\S]*?)</a>', 2) AS first_text FROM pages)
SELECT page_id, own AS host, CAST(1 AS INTEGER) AS rank, substr(first_text, 1, 120) AS sample FROM p
UNION ALL SELECT page_id, 'partner' || (page_id % 3) || '.example.org', 2, 'Partner' FROM p"""
)
def outbound_hosts(spark, sf_dir):
    extra = F.concat(
        F.lit('<a class="x" href="https://www.partner'), (F.col("page_id") % 3).cast("string"),
        F.lit('.example.org/a">Partner</a><a href="https://www.google.com/q">search</a><a href="mailto:x@y.example">mail</a>'),
    )
    rows = spread_table(spark, sf_dir, "pages").select("page_id", "url", F.concat("html", extra).alias("html"))
    return pf.outbound_hosts(rows, "html", "url").select("page_id", "host", "rank", "sample")


_KIC = """
WITH d AS (SELECT doc_id, text, needle, position(needle IN text) AS p1 FROM documents, (SELECT unnest(['the', 'eau']) AS needle)),
e AS (SELECT *, position(needle IN substr(text, p1 + 1)) AS q2 FROM d WHERE p1 > 0),
f AS (SELECT *, CASE WHEN q2 > 0 THEN p1 + q2 END AS p2 FROM e),
g AS (SELECT *, CASE WHEN p2 IS NOT NULL THEN position(needle IN substr(text, p2 + 1)) END AS q3 FROM f),
h AS (SELECT *, CASE WHEN q3 > 0 THEN p2 + q3 END AS p3 FROM g),
a AS (SELECT doc_id, text, needle, 1 AS hit, p1 AS pos FROM h UNION ALL SELECT doc_id, text, needle, 2, p2 FROM h WHERE p2 IS NOT NULL
      UNION ALL SELECT doc_id, text, needle, 3, p3 FROM h WHERE p3 IS NOT NULL)
SELECT doc_id, needle, CAST(hit AS INTEGER) AS hit, CAST(pos AS BIGINT) AS "at",
       md5(substr(text, greatest(pos - 150, 1), pos + 250 - greatest(pos - 150, 1))) AS context FROM a"""


@query(_KIC)
def keyword_in_context(spark, sf_dir):
    out = pf.keyword_in_context(spread_table(spark, sf_dir, "documents").select("doc_id", "text"), "text", ["the", "eau"])
    return out.withColumn("context", F.md5(F.col("context").cast("binary")))


@query(
    """
WITH p AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs, ['la', 'TH', 'zz'][page_id % 3 + 1] AS needle FROM pages)
SELECT page_id, needle, list_filter(hrefs, lambda h: contains(lower(h), lower(needle)))[1] AS href FROM p"""
)
def href_for_id(spark, sf_dir):
    needle = F.element_at(F.array(F.lit("la"), F.lit("TH"), F.lit("zz")), (F.col("page_id") % 3 + 1).cast("int"))
    return spread_table(spark, sf_dir, "pages").select(
        "page_id", needle.alias("needle"), pf.href_with(F.col("html"), needle).alias("href")
    )


@query(
    """
WITH p AS (SELECT page_id, regexp_extract_all(html || '<script id="s1" defer><script type="application/json"><script type="text/javascript">',
                                              '(?i)<script\\b([^>]*)>', 1) AS tags FROM pages)
SELECT page_id, CAST(len(tags) AS BIGINT) AS scripts, CAST(2 AS BIGINT) AS marked, 'id="s1" defer | type="application/json"' AS attributes FROM p"""
)
def script_tag_inventory(spark, sf_dir):
    extra = '<script id="s1" defer><script type="application/json"><script type="text/javascript">'
    rows = spread_table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.lit(extra)).alias("html"))
    out = rows.select("page_id", *pf.script_tags(F.col("html")))
    return out.withColumn("attributes", F.array_join("attributes", " | "))


@query(
    """
SELECT page_id, nullif(regexp_extract(html, '(?i)article>', 0), '') AS count_text,
       array_to_string(regexp_extract_all(html, '(?i)href="/[a-m][^"]*"')[1:3], ' ') AS paging,
       array_to_string(list_distinct(regexp_extract_all(html, '(?i)href="/[^"]*"'))[1:4], ' ') AS details_any,
       CAST(len(list_distinct(regexp_extract_all(html, '(?i)href="/[^"]*"'))[1:4]) AS INTEGER) AS n_details
FROM pages""".replace("       array_to_string(list_distinct(regexp_extract_all(html, '(?i)href=\"/[^\"]*\"'))[1:4], ' ') AS details_any,\n", "")
)
def page_link_sample(spark, sf_dir):
    cols = pf.result_page_links(F.col("html"), r"(?i)article>", r'(?i)href="/[a-m][^"]*"', r'(?i)href="/[^"]*"')
    out = spread_table(spark, sf_dir, "pages").select("page_id", *cols)
    return out.select("page_id", "count_text", F.array_join("paging", " ").alias("paging"), F.size("details").alias("n_details"))


@query(
    """
SELECT page_id, script_no, length(script) AS chars FROM (
  SELECT page_id, unnest(s) AS script, CAST(unnest(range(len(s))) AS INTEGER) AS script_no
  FROM (SELECT page_id, regexp_extract_all(html, '(?i)<script\\b[^>]*>([\\s\\S]*?)</script>', 1) AS s FROM pages)) WHERE length(script) > 22"""
)
def large_scripts(spark, sf_dir):
    out = pf.large_scripts(spread_table(spark, sf_dir, "pages").select("page_id", "html"), "html", at_least=22)
    return out.select("page_id", "script_no", F.length("script").cast("bigint").alias("chars"))


@query(
    """
WITH t AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE '==A==' || text || CASE WHEN doc_id % 3 = 1 THEN ' ==B== tail ' ELSE '' END END AS t FROM documents),
s AS (SELECT doc_id, coalesce(string_split(t, '==A==')[2], '') AS r FROM t)
SELECT doc_id, md5(regexp_replace(string_split(r, '==B==')[1], '^\\s+|\\s+$', '', 'g')) AS a,
       regexp_replace(coalesce(string_split(r, '==B==')[2], ''), '^\\s+|\\s+$', '', 'g') AS b FROM s"""
)
def split_sections(spark, sf_dir):
    k = F.col("doc_id") % 3
    body = F.when(k == 0, F.col("text")).otherwise(
        F.concat(F.lit("==A=="), "text", F.when(k == 1, " ==B== tail ").otherwise(""))
    )
    rows = spread_table(spark, sf_dir, "documents").select("doc_id", body.alias("t"))
    out = rows.select("doc_id", *pf.split_sections(F.col("t"), [("a", "==A=="), ("b", "==B==")]))
    return out.withColumn("a", F.md5(F.col("a").cast("binary")))


@query(
    """
WITH c AS (SELECT regexp_extract(url, 'example\\.[a-z]+', 0) AS site, page_id AS pos, html AS post_data FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY pos) AS rn FROM c)
SELECT site, pos, CAST(CASE WHEN length(post_data) > 4000 THEN 4014 ELSE length(post_data) END AS INTEGER) AS chars FROM r WHERE rn <= 60"""
)
def landing_cap(spark, sf_dir):
    rows = spread_table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", r"example\.[a-z]+", 0).alias("site"), F.col("page_id").alias("pos"), F.col("html").alias("post_data")
    )
    return pf.landing_cap(rows, ["site"]).select("site", "pos", F.length("post_data").alias("chars"))


_CAP_SQL = """
WITH c AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'https://api.mixpanel.com/x' WHEN page_id % 5 = 1 THEN url || '/r.data' ELSE url END AS url,
                  CASE WHEN page_id % 4 = 0 THEN 'application/JSON' ELSE 'text/html' END AS content_type,
                  CASE page_id % 3 WHEN 0 THEN '{"hits": [' || page_id || ']}' WHEN 1 THEN '  [1, 2, "' || url || '"]' ELSE html END AS body FROM pages)
"""


@query(
    _CAP_SQL
    + """SELECT page_id, regexp_matches(content_type, 'json', 'i') OR regexp_matches(url, '\\.data(\\?|$)', 'i') AS candidate,
       regexp_matches(body, '"(lots?|items?|hits?|results?|catalogs?|auctionlots?)"\\s*:|salePrice|priceResult|estimate\\b|hammer\\b|soldPrice|lotNumber', 'i')
         OR (NOT contains(url, 'mixpanel') AND length(trim(body)) > 20 AND regexp_matches(trim(body), '^[{\\[]')) AS wanted,
       CAST(2 AS INTEGER) AS headers FROM c"""
)
def capture_filter(spark, sf_dir):
    k5, k3 = F.col("page_id") % 5, F.col("page_id") % 3
    p = spread_table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(k5 == 0, "https://api.mixpanel.com/x").when(k5 == 1, F.concat("url", F.lit("/r.data"))).otherwise(F.col("url")).alias("url"),
        F.when(F.col("page_id") % 4 == 0, "application/JSON").otherwise("text/html").alias("content_type"),
        F.when(k3 == 0, F.concat(F.lit('{"hits": ['), F.col("page_id").cast("string"), F.lit("]}")))
        .when(k3 == 1, F.concat(F.lit('  [1, 2, "'), F.col("url"), F.lit('"]')))
        .otherwise(F.col("html")).alias("body"),
    )
    headers = F.create_map(
        F.lit("Accept"), F.lit("*/*"), F.lit("x-api-key"), F.col("url"), F.lit("sec-fetch-mode"), F.lit("cors"), F.lit("ocp-key"), F.lit("1")
    )
    return p.select(
        "page_id",
        pf.is_candidate_response(F.col("url"), F.col("content_type")).alias("candidate"),
        pf.is_candidate_body(F.col("url"), F.col("body")).alias("wanted"),
        F.size(pf.notable_headers(headers)).alias("headers"),
    )


def _shape_body():
    return F.concat(
        F.lit('{"results":[{"hits":[1,2,'), F.col("event_id").cast("string"), F.lit('],"nbHits":'), F.col("user_id").cast("string"),
        F.lit(',"facet":"[x]"}],"page":2,"props":'), F.col("props"), F.lit("}"),
    )


@query(
    """
SELECT event_id, 'results,page,props' AS top_keys, 'results:1 [nested].[nested].hits:3' AS arrays, 'page=2 nbHits=' || user_id AS paging FROM events"""
)
def json_shape_profile(spark, sf_dir):
    rows = spread_table(spark, sf_dir, "events", rows=200_000).select("event_id", _shape_body().alias("body"))
    out = pf.json_shape(rows, "body")
    return out.select(
        "event_id", "top_keys", F.array_join("arrays", " ").alias("arrays"), F.array_join("paging", " ").alias("paging")
    )


@query(
    """
SELECT event_id, '$' || repeat('.a', [0, 10, 40][1 + event_id % 3]) || '.page.list[' || i || '].lot' AS path, i + event_id AS lot_number, value AS price
FROM events, (SELECT unnest([0, 1]) AS i)"""
)
def lot_objects(spark, sf_dir):
    lot = lambda i: F.concat(
        F.lit('{"lot":{"LotNumber":'), (F.col("event_id") + i).cast("string"), F.lit(',"salePrice":'), F.col("value").cast("string"),
        F.lit(',"inner":{"lotNumber":1,"salePrice":2}}}'),
    )
    body = F.concat(F.lit('{"b":{"lotNumber":1},"page":{"list":['), lot(0), F.lit(","), lot(1), F.lit("]}}"))
    around = F.element_at(F.array(F.lit(0), F.lit(10), F.lit(40)), (F.col("event_id") % 3 + 1).cast("int"))
    body = F.concat(F.repeat(F.lit('{"a":'), around), body, F.repeat(F.lit("}"), around))
    rows = spread_table(spark, sf_dir, "events").select("event_id", body.alias("body"))
    out = pf.lot_objects(rows, "body")
    v = F.try_parse_json("lot")
    return out.select(
        "event_id", "path", F.try_variant_get(v, "$.LotNumber", "bigint").alias("lot_number"),
        F.try_variant_get(v, "$.salePrice", "double").alias("price"),
    )
