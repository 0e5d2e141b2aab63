"""Profiling landed pages and captured responses."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.text import domain_of, page_text, tidy
from gavelkit.session import pinned
from gavelkit.sources.extract.base import computed_once


def _count(text: Column, needle: str) -> Column:
    """Occurrences of a literal, ignoring case."""
    return F.regexp_count(text, F.lit("(?iu)" + re.escape(needle))).cast("bigint")


def signal_counts(rows: DataFrame, body: str, needles: dict[str, str]) -> DataFrame:
    """One count column per needle."""
    return rows.select("*", *[_count(F.col(body), n).alias(name) for name, n in needles.items()])


def needles_found(body: Column, needles: list[str]) -> Column:
    """The needles that occur, in list order."""
    return F.filter(F.array(*[F.lit(n) for n in needles]), lambda n: F.contains(body, n))


def large_scripts(rows: DataFrame, html: str, at_least: int = 2000) -> DataFrame:
    """The script bodies above a size, one row each, numbered in page order."""
    bodies = F.regexp_extract_all(F.col(html), F.lit(r"(?i)<script\b[^>]*>([\s\S]*?)</script>"), F.lit(1))
    return rows.select("*", F.posexplode(bodies).alias("script_no", "script")).where(F.length("script") > at_least)


def page_verdict(status: Column, html: Column, signatures: list[str] | None = None,
                 small: int = fixed.SMALL_PAGE_CHARS) -> Column:
    """Whether a page is blocked, an error, suspiciously small or real."""
    blocked = F.lit(False)
    for s in signatures or fixed.BLOCK_SIGNATURES:
        blocked = blocked | F.contains(html, F.lit(s))
    return (
        F.when(blocked, "blocked")
        .when(status >= 400, F.concat(F.lit("http "), status.cast("string")))
        .when(F.length(html) < small, "small")
        .otherwise("real")
    )


def wall_marker(body: Column, title: Column, markers: list[str] | None = None) -> Column:
    """The first marker of a bot wall found in a page, else null."""
    hay = F.lower(F.concat_ws(" ", F.coalesce(body, F.lit("")), F.coalesce(title, F.lit(""))))
    return F.get(needles_found(hay, markers or fixed.WALL_MARKERS), F.lit(0))


def page_title(html: Column) -> Column:
    return tidy(F.regexp_extract(html, r"(?i)<title>([^<]*)</title>", 1))


def page_features(html: Column) -> list[Column]:
    """What a page offers an extractor: embedded state, linked data, search ids, prices, title."""
    prices = F.regexp_extract_all(html, F.lit(r"\$[\d,]{2,7}(?:\.\d{2})?"), F.lit(0))
    found = lambda pattern: F.nullif(F.regexp_extract(html, pattern, 1), F.lit(""))
    return [
        F.contains(html, F.lit("__NEXT_DATA__")).alias("has_next_data"),
        F.contains(html, F.lit("__NUXT__")).alias("has_nuxt_data"),
        (
            F.contains(html, F.lit('type="application/ld+json"'))
            | F.contains(html, F.lit("type='application/ld+json'"))
        ).alias("has_json_ld"),
        html.rlike("(?i)algolia").alias("mentions_search"),
        html.rlike(r'(?i)appId["\s:]').alias("mentions_app_id"),
        found(r'(?i)["\']?appId["\']?\s*[:=]\s*["\']([A-Z0-9]{6,12})["\']').alias("app_id"),
        found(r'(?i)["\']?indexName["\']?\s*[:=]\s*["\']([\w.-]+)["\']').alias("index_name"),
        F.size(prices).cast("bigint").alias("price_mentions"),
        F.slice(F.array_distinct(prices), 1, 10).alias("sample_prices"),
        page_title(html).alias("title"),
    ]


def product_facts(html: Column, keywords: list[str]) -> list[Column]:
    """Image, first price with cents, a text snippet, keyword hits, seller byline and vendor."""
    plain = page_text(html)
    byline = r"(?i)(sold by|seller:|consigned by)\s*[:\-]?\s*([A-Z][\w&.,' -]{2,40})"
    some = lambda c: F.nullif(c, F.lit(""))
    return [
        some(F.regexp_extract(html, r'(?i)<meta property="og:image" content="([^"]+)"', 1)).alias("image"),
        some(F.regexp_extract(html, r"\$[\d,]+\.\d{2}", 0)).alias("price"),
        F.left(plain, F.lit(400)).alias("snippet"),
        needles_found(F.lower(plain), keywords).alias("keywords"),
        some(F.regexp_extract(plain, byline, 0)).alias("byline"),
        some(F.regexp_extract(html, r'(?i)"vendor"\s*:\s*"([^"]+)"', 1)).alias("vendor"),
    ]


def phrase_audit(rows: DataFrame, body: str, phrases: list[str]) -> DataFrame:
    """One row per page and phrase: whether the page contains it, ignoring case."""
    low = F.lower(F.col(body))
    checks = F.array(*[F.struct(F.lit(p).alias("phrase"), F.contains(low, F.lit(p)).alias("present")) for p in phrases])
    keep = [c for c in rows.columns if c != body]
    return rows.select(*keep, F.explode(checks).alias("c")).select(*keep, "c.phrase", "c.present")


_ANCHOR = r'(?i)<a\b[^>]*?href=["\']([^"\']*)["\'][^>]*>([\s\S]*?)</a>'


def outbound_hosts(rows: DataFrame, html: str, base: str, limit: int = 15,
                   excluded: list[str] | None = None) -> DataFrame:
    """The distinct hosts a page links to, in page order, with the text of the first link.

    Relative links belong to the page's own host. A page has few links, so the ranking per
    page is small.
    """
    hrefs = F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(1))
    texts = F.regexp_extract_all(F.col(html), F.lit(_ANCHOR), F.lit(2))
    keep = [c for c in rows.columns if c not in (html, base)]
    links = rows.select(*keep, base, F.posexplode(F.arrays_zip(hrefs.alias("href"), texts.alias("text"))).alias("at", "l"))
    href = F.col("l.href")
    absolute = (
        F.when(href.rlike("^https?://"), href)
        .when(href.startswith("//"), F.concat(F.lit("https:"), href))
        .when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.col(base))
    )
    links = links.select(*keep, "at", absolute.alias("url"), F.left(tidy(F.regexp_replace("l.text", "<[^>]*>", "")), F.lit(120)).alias("sample"))
    links = links.where(F.col("url").isNotNull())
    for host in excluded or fixed.SEARCH_HOSTS:
        links = links.where(~F.contains(F.col("url"), F.lit(host)))
    hosts = links.groupBy(*keep, domain_of(F.col("url")).alias("host")).agg(
        F.min("at").alias("at"), F.min_by("sample", "at").alias("sample")
    )
    rank = F.row_number().over(Window.partitionBy(*keep).orderBy("at"))
    return hosts.withColumn("rank", rank).where(F.col("rank") <= limit).drop("at")


def keyword_in_context(rows: DataFrame, body: str, needles: list[str], hits: int = 3, before: int = 150,
                       after: int = 250, ignore_case: bool = False) -> DataFrame:
    """The first occurrences of each needle with the text around them; occurrences may overlap."""
    text = F.col(body)
    hay = F.lower(text) if ignore_case else text
    found = []
    for needle in needles:
        wanted = F.lit(needle.lower() if ignore_case else needle)
        at = F.position(wanted, hay, F.lit(1))
        for no in range(1, hits + 1):
            found.append(F.struct(F.lit(needle).alias("needle"), F.lit(no).alias("hit"), at.alias("at")))
            at = F.when(at > 0, F.position(wanted, hay, at + 1)).otherwise(0)
    keep = [c for c in rows.columns if c != body]
    out = rows.select(*keep, text.alias("_t"), F.explode(F.filter(F.array(*found), lambda s: s["at"] > 0)).alias("s"))
    start = F.greatest(F.col("s.at") - F.lit(before), F.lit(1))
    stop = F.col("s.at") + F.lit(after)
    return out.select(
        *keep, "s.needle", "s.hit", F.col("s.at").cast("bigint").alias("at"),
        F.substr("_t", start, stop - start).alias("context"),
    )


def href_with(html: Column, needle: Column) -> Column:
    """The first link target of a page that contains the needle, ignoring case."""
    hrefs = F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))
    return F.get(F.filter(hrefs, lambda h: F.contains(F.lower(h), F.lower(needle))), F.lit(0))


def script_tags(html: Column) -> list[Column]:
    """Script tags of a page: how many, and those with an id or a type other than JavaScript."""
    tags = F.transform(F.regexp_extract_all(html, F.lit(r"(?i)<script\b([^>]*)>"), F.lit(1)), tidy)
    marked = F.filter(
        tags, lambda t: t.rlike(r'(?i)(?<![A-Za-z0-9_])(id=|type=(?!"text/javascript"|"application/javascript"))')
    )
    return [
        F.size(tags).cast("bigint").alias("scripts"),
        F.size(marked).cast("bigint").alias("marked"),
        F.slice(marked, 1, 30).alias("attributes"),
    ]


def result_page_links(html: Column, count_pattern: str, paging_pattern: str, detail_pattern: str) -> list[Column]:
    """The result-count text, the first three paging links and the first four distinct detail links."""
    paging = F.regexp_extract_all(html, F.lit(paging_pattern), F.lit(0))
    detail = F.regexp_extract_all(html, F.lit(detail_pattern), F.lit(0))
    return [
        F.nullif(F.regexp_extract(html, count_pattern, 0), F.lit("")).alias("count_text"),
        F.slice(paging, 1, 3).alias("paging"),
        F.slice(F.array_distinct(detail), 1, 4).alias("details"),
    ]


def split_sections(text: Column, markers: list[tuple[str, str]]) -> list[Column]:
    """The text after each marker up to the next, as named columns; a missing part is empty."""
    out, rest = [], text
    for i, (name, marker) in enumerate(markers):
        rest = F.coalesce(F.get(F.split(rest, re.escape(marker)), F.lit(1)), F.lit(""))
        end = markers[i + 1][1] if i + 1 < len(markers) else None
        part = F.get(F.split(rest, re.escape(end)), F.lit(0)) if end else rest
        out.append(tidy(part).alias(name))
    return out


# --- captured responses -------------------------------------------------------------
def is_candidate_response(url: Column, content_type: Column) -> Column:
    return F.coalesce(content_type, F.lit("")).rlike("(?i)json") | url.rlike(r"(?i)\.data(\?|$)")


def is_candidate_body(url: Column, body: Column, extra_pattern: str = "") -> Column:
    """A body worth reading: it names lots or prices, or is JSON from a host that is no tracker."""
    t = tidy(body)
    wanted = fixed.CANDIDATE_BODY + (f"|{extra_pattern}" if extra_pattern else "")
    return body.rlike(wanted) | (~url.rlike(fixed.NOISE_HOSTS) & (F.length(t) > 20) & t.rlike(r"^[{\[]"))


def notable_headers(headers: Column) -> Column:
    """Request headers without the ones every browser sends."""
    return F.map_filter(headers, lambda k, v: ~k.rlike(fixed.PLAIN_HEADERS))


def landing_cap(captures: DataFrame, page_key: list[str], cap: int = fixed.LANDING_CAP) -> DataFrame:
    """At most ``cap`` responses per page, in capture order; long request bodies are cut.

    The rank filter sits on the window, so each task keeps at most ``cap`` rows per page
    before the shuffle.
    """
    ranked = captures.withColumn("_rn", F.row_number().over(Window.partitionBy(*page_key).orderBy("pos")))
    limit = fixed.POST_DATA_CHARS
    cut = F.when(
        F.length("post_data") > limit, F.concat(F.left("post_data", F.lit(limit)), F.lit("...(truncated)"))
    ).otherwise(F.col("post_data"))
    return ranked.where(F.col("_rn") <= cap).drop("_rn").withColumn("post_data", cut)


def _array_lengths(entries: Column, prefix: str) -> Column:
    length = lambda e: F.json_array_length(F.to_json(e["value"])).cast("string")
    return F.transform(entries, lambda e: F.concat(F.lit(prefix), e["key"], F.lit(":"), length(e)))


def json_shape(rows: DataFrame, body: str) -> DataFrame:
    """Top-level keys, arrays with their lengths and paging numbers, three levels deep.

    Below the top only the first child that holds an object or array is followed.
    """
    keep = [c for c in rows.columns if c != body]
    # each level's text and entries are generated, so that they are parsed once and not in every use
    out = computed_once(rows, "_v", F.try_parse_json(body)).where(F.col("_v").isNotNull())
    node, prefix, arrays, paging = F.col(body), "", [], []
    for level in range(3):
        out = computed_once(out, f"_node{level}", node)
        node = F.col(f"_node{level}")
        fields = F.map_entries(F.from_json(node, "map<string,variant>"))
        items = F.transform(
            F.from_json(node, "array<variant>"), lambda v, i: F.struct(i.cast("string").alias("key"), v.alias("value"))
        )
        out = computed_once(out, f"_entries{level}", F.when(tidy(node).startswith("["), items).otherwise(fields))
        entries = F.col(f"_entries{level}")
        kind = lambda e: F.schema_of_variant(e["value"])
        arrays.append(_array_lengths(F.filter(entries, lambda e: kind(e).startswith("ARRAY")), prefix))
        numeric = r"^(BIGINT|DOUBLE|DECIMAL)"
        paging.append(
            F.transform(
                F.filter(entries, lambda e: e["key"].rlike(fixed.PAGINATION_KEY) & kind(e).rlike(numeric)),
                lambda e: F.concat(e["key"], F.lit("="), F.to_json(e["value"])),
            )
        )
        node = F.to_json(F.get(entries, F.lit(0))["value"])
        prefix = "[nested]." + prefix
    none = F.array().cast("array<string>")
    flat = lambda parts: F.flatten(F.array(*[F.coalesce(p, none) for p in parts]))
    is_list = F.schema_of_variant("_v").startswith("ARRAY")
    keys = F.when(is_list, F.concat(F.lit("array["), F.json_array_length(body).cast("string"), F.lit("]"))).otherwise(
        F.array_join(F.json_object_keys(body), ",")
    )
    return out.select(*keep, keys.alias("top_keys"), flat(arrays).alias("arrays"), flat(paging).alias("paging"))


def lot_objects(rows: DataFrame, body: str, levels: int = 8) -> DataFrame:
    """Objects anywhere in a JSON document, at any depth, that carry a lot number and a price.

    Level by level without a shuffle: open objects and arrays are replaced by their children,
    matches stay as they are and are not searched further. ``levels`` levels are one chain, whose
    result is written; what is still open then goes through the next chain, until nothing is. So a
    document costs its own depth, and only deep ones are read again. Null and broken documents give
    no row; Spark's parser takes those of over 1,000 levels as broken.
    """
    found, kept = [], F.struct(*[c for c in rows.columns if c != body]).alias("_kept")
    start = rows.select(kept, F.lit("$").alias("path"), F.col(body).alias("lot"))
    while True:
        done = pinned(_lot_levels(start, levels), "lots")
        found.append(done.where("done").select("_kept.*", "path", "lot"))
        start = done.where("NOT done").drop("done")
        if start.isEmpty():
            return reduce(DataFrame.unionByName, found)


def _lot_levels(rows: DataFrame, levels: int) -> DataFrame:
    """One chain over rows (_kept, path, lot): those that are done, and those still open."""
    spark = rows.sparkSession
    wanted = F.array(*[F.lit(k) for k in [fixed.LOT_KEY, *fixed.LOT_PRICE_KEYS]])
    roles = lambda keys: F.transform(
        F.filter(keys, lambda k: F.array_contains(wanted, F.lower(k))), lambda k: F.lower(k) == fixed.LOT_KEY
    )
    # one step into the document; its whole text or schema would cost the rest of its depth at every level
    fields, items = (F.try_variant_get("node", "$", t) for t in ("map<string,variant>", "array<variant>"))
    # both a lot number and a price: the two roles differ
    is_lot = F.coalesce(F.size(F.array_distinct(roles(F.map_keys(fields)))) == 2, F.lit(False))
    # exploding a one-element array keeps the parsed document from being parsed again per use
    level = rows.select("_kept", "path", F.explode(F.array(F.try_parse_json("lot"))).alias("node"))
    level = level.where("node IS NOT NULL").withColumn("lot", is_lot)
    for _ in range(levels):
        # of what is no object or array nothing comes out
        inside = F.when(~F.col("lot"), F.col("node"))
        child = level.lateralJoin(spark.tvf.variant_explode_outer(inside.outer()))
        step = F.when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(
            F.concat(F.lit("."), F.col("key"))
        )
        level = child.select(
            "_kept",
            F.when(F.col("lot"), F.col("path")).otherwise(F.concat("path", step)).alias("path"),
            F.when(F.col("lot"), F.col("node")).otherwise(F.col("value")).alias("node"),
            F.col("lot").alias("_was"),
        ).where("node IS NOT NULL")
        level = level.select("_kept", "path", "node", (F.col("_was") | is_lot).alias("lot"))
    filled = F.coalesce(F.size(fields) > 0, F.size(items) > 0, F.lit(False))
    ends = level.where(F.col("lot") | filled)
    return ends.select("_kept", "path", F.to_json("node").alias("lot"), F.col("lot").alias("done"))
