"""Registered queries: scalar functions on numbers, dates and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit.functions import dates, fixed, numbers, text
from gavelkit.plans.adapters import LISTINGS_SQL, SALES_SQL, listings, sales, spread_table, table, with_views
from gavelkit.plans.pairs import TOKENS_SQL
from gavelkit.plans.registry import Registry

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles

NORM_URL_SQL = "regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^?#]*)', 1)), '/+$', '')"


def comma_sql(x: str) -> str:
    return f"format('{{:,}}', CAST(floor(({x}) + 0.5::DOUBLE) AS BIGINT))"


@query(f"SELECT page_id, {NORM_URL_SQL} AS norm FROM pages")
def norm_url(spark, sf_dir):
    return spread_table(spark, sf_dir, "pages").select("page_id", text.norm_url(F.col("url")).alias("norm"))


@query("SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '^www\\.', '') AS host FROM pages")
def domain_of(spark, sf_dir):
    return spread_table(spark, sf_dir, "pages").select("page_id", text.domain_of(F.col("url")).alias("host"))


@query(
    f"""
WITH p AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE '' END AS url, '  The  House ' || (page_id % 7) AS house,
                  CASE WHEN page_id % 2 = 0 THEN 'SKU ' || page_id ELSE '' END AS sku, page_id * 0.5::DOUBLE AS price FROM pages),
u AS (SELECT *, {NORM_URL_SQL} AS u FROM p)
SELECT page_id,
  CASE WHEN u <> '' THEN 'url:' || u
       ELSE 'meta:' || lower(trim(house)) || '|' || lower(trim(sku)) || '|2024-01|' || regexp_replace(lower(trim(house)), '\\s+', ' ', 'g') END AS auction_key,
  CASE WHEN u <> '' THEN 'url:' || u WHEN sku <> '' THEN 'sku:' || lower(trim(house)) || '|' || lower(sku)
       ELSE 'meta:' || lower(trim(house)) || '|' || regexp_replace(lower(trim(house)), '\\s+', ' ', 'g') END AS listing_key,
  CASE WHEN u <> '' THEN 'url:' || u
       ELSE 'meta:' || lower(trim(house)) || '|' || regexp_replace(lower(trim(house)), '\\s+', ' ', 'g') || '|asking|'
            || CASE WHEN price = floor(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR) ELSE CAST(price AS VARCHAR) END END AS sighting_key
FROM u"""
)
def record_keys(spark, sf_dir):
    p = spread_table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise("").alias("url"),
        F.concat(F.lit("  The  House "), (F.col("page_id") % 7).cast("string")).alias("house"),
        F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("SKU "), F.col("page_id").cast("string"))).otherwise("").alias("sku"),
        (F.col("page_id") * 0.5).alias("price"),
    )
    url, house, sku = F.col("url"), F.col("house"), F.col("sku")
    return p.select(
        "page_id",
        text.auction_key(url, house, sku, F.lit(" 2024-01 "), house).alias("auction_key"),
        text.listing_key(url, house, sku, house).alias("listing_key"),
        text.sighting_key(url, house, house, F.lit("Asking"), F.col("price")).alias("sighting_key"),
    )


@query(
    """
SELECT event_id, CASE WHEN value >= 50 THEN value END AS plausible, CASE WHEN value - 100 > 0 THEN value - 100 END AS positive,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS DOUBLE) END AS parsed FROM events"""
)
def plausible_price(spark, sf_dir):
    e = spread_table(spark, sf_dir, "events")
    mixed = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).when(
        F.col("event_id") % 3 == 0, F.lit("NaN")
    ).otherwise("n/a")
    return e.select(
        "event_id", numbers.plausible(F.col("value")).alias("plausible"),
        numbers.positive(F.col("value") - 100).alias("positive"), numbers.number(mixed).alias("parsed"),
    )


def _chain(x: str, pairs) -> str:
    for a, b in pairs:
        b = b.replace("'", "''")
        x = f"replace({x}, '{a}', '{b}')"
    return x


@query(
    f"""
WITH h AS (SELECT page_id, html || '&amp;lt;&quot;&#039;&amp;#039;' AS html FROM pages)
SELECT page_id, md5({_chain('html', text._ENTITIES_A)}) AS once, md5({_chain('html', text._ENTITIES_B)}) AS twice FROM h"""
)
def decode_entities(spark, sf_dir):
    html = F.concat(F.col("html"), F.lit("&amp;lt;&quot;&#039;&amp;#039;"))
    return spread_table(spark, sf_dir, "pages").select(
        "page_id",
        F.md5(text.decode_entities(html, "A").cast("binary")).alias("once"),
        F.md5(text.decode_entities(html, "B").cast("binary")).alias("twice"),
    )


_SQUEEZE = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


@query(
    f"""
SELECT page_id, md5({_SQUEEZE.format(_chain("regexp_replace(html, '<[^>]*>', ' ', 'g')", text._ENTITIES_A))}) AS strip_a,
       md5({_SQUEEZE.format("regexp_replace(" + _chain('html', text._ENTITIES_D) + ", '<[^>]*>', ' ', 'g')")}) AS strip_b,
       md5(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<script[\\s\\S]*?</script>', '', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS page_text
FROM pages"""
)
def html_to_text(spark, sf_dir):
    html = F.col("html")
    return spread_table(spark, sf_dir, "pages").select(
        "page_id",
        F.md5(text.strip_tags(html, "A").cast("binary")).alias("strip_a"),
        F.md5(text.strip_tags(html, "B").cast("binary")).alias("strip_b"),
        F.md5(text.page_text(html).cast("binary")).alias("page_text"),
    )


def _category_sql(variant: str) -> str:
    parts = []
    for name, pattern in fixed.CATEGORY_RULES[variant]:
        if "(?!link)" in pattern:
            plain = pattern.replace("|cuff(?!link)", "")
            parts.append(f"WHEN regexp_matches(t, '{plain}') OR contains(replace(t, 'cufflink', ' '), 'cuff') THEN '{name}'")
        else:
            parts.append(f"WHEN regexp_matches(t, '{pattern}') THEN '{name}'")
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


@query(
    f"""
WITH x AS (SELECT doc_id, lower(text) AS t FROM documents UNION ALL
           SELECT -1 - p_partkey, lower(p_name || ' ' || ['Cufflinks', 'cuff', 'pin', 'hoop', 'earclip', 'Pendant'][p_partkey % 6 + 1]) FROM part)
SELECT doc_id, {_category_sql('A')} AS cat_a, {_category_sql('B')} AS cat_b, {_category_sql('C')} AS cat_c FROM x"""
)
def categorize_text(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in ("Cufflinks", "cuff", "pin", "hoop", "earclip", "Pendant")])
    part = spread_table(spark, sf_dir, "part").select(
        (-1 - F.col("p_partkey")).alias("doc_id"),
        F.concat_ws(" ", "p_name", F.element_at(words, (F.col("p_partkey") % 6 + 1).cast("int"))).alias("text"),
    )
    rows = spread_table(spark, sf_dir, "documents").select("doc_id", "text").unionByName(part)
    return rows.select("doc_id", *[text.category_of(F.col("text"), v).alias(f"cat_{v.lower()}") for v in "ABC"])


_ERA_TEXT = "text || ' made ' || (CASE doc_id % 4 WHEN 0 THEN 'Circa  ' ELSE '' END) || CAST(1930 + doc_id % 120 AS VARCHAR) || (CASE doc_id % 3 WHEN 0 THEN 's' ELSE '' END)"


def _era_text():
    return F.concat(
        F.col("text"), F.lit(" made "), F.when(F.col("doc_id") % 4 == 0, "Circa  ").otherwise(""),
        (1930 + F.col("doc_id") % 120).cast("string"), F.when(F.col("doc_id") % 3 == 0, "s").otherwise(""),
    )


@query(
    f"""
SELECT doc_id, trim(regexp_extract({_ERA_TEXT}, '(?i)\\b(circa\\s*)?(19\\d0s|19\\d{{2}}|20\\d{{2}})\\b', 0)) AS era FROM documents"""
)
def era_of_text(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", text.era_of(_era_text()).alias("era"))


@query(
    f"""
WITH y AS (SELECT doc_id, regexp_extract({_ERA_TEXT}, '\\b(19[4-9]\\d)s?\\b', 1) AS y FROM documents)
SELECT doc_id, CASE WHEN y <> '' THEN substr(y, 1, 3) || '0s' END AS decade FROM y"""
)
def decade_of(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", text.decade_of(_era_text()).alias("decade"))


_TAG_WORDS = ["Zodiac ring", "a LION, carved", "fish scale", "BOMBÉ dome", "door  knocker", "rock crystal cuff", "owls", "shell"]
_TAG_LIST_SQL = "[" + ", ".join(f"'{w}'" for w in _TAG_WORDS) + "]"


@query(
    f"""
WITH x AS (SELECT doc_id, text || ' ' || {_TAG_LIST_SQL}[doc_id % {len(_TAG_WORDS)} + 1] AS t FROM documents)
SELECT doc_id, array_to_string(list_filter([{", ".join(f"CASE WHEN regexp_matches(t, '{p}', 'i') THEN '{n}' END" for n, p in fixed.TAG_RULES)}],
       lambda z: z IS NOT NULL), '; ') AS tags FROM x"""
)
def infer_tags(spark, sf_dir):
    words = F.array(*[F.lit(w) for w in _TAG_WORDS])
    body = F.concat_ws(" ", "text", F.element_at(words, (F.col("doc_id") % len(_TAG_WORDS) + 1).cast("int")))
    tags = text.tags_of(body, F.lit(None).cast("string"))
    return spread_table(spark, sf_dir, "documents").select("doc_id", F.array_join(tags, "; ").alias("tags"))


@query(
    """
WITH m AS (SELECT o_orderkey, floor(o_totalprice) AS low, floor(o_totalprice * 1.5::DOUBLE) AS high FROM orders)
SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN 'CHF' END AS currency, CASE WHEN o_orderkey % 5 <> 0 THEN low END AS amount,
       'USD' AS range_currency, low, high, low AS first_dollars, low + 0.25::DOUBLE AS last_cents,
       CASE o_orderkey % 3 WHEN 0 THEN '40% off Est. Retail $' || format('{:,}', CAST(high AS BIGINT))
                           WHEN 1 THEN 'Est. Retail $' || format('{:,}', CAST(high AS BIGINT)) ELSE '' END AS retail
FROM m"""
)
def parse_money_text(spark, sf_dir):
    o = spread_table(spark, sf_dir, "orders")
    low, high = F.floor("o_totalprice"), F.floor(F.col("o_totalprice") * 1.5)
    lo, hi = F.format_number(low, 0), F.format_number(high, 0)
    kind = F.col("o_orderkey") % 3
    single = F.concat(F.when(F.col("o_orderkey") % 5 == 0, "about CHF ").otherwise("CHF "), lo)
    double = F.concat(F.lit("USD "), lo, F.lit(" - "), hi)
    block = F.concat(
        F.when(kind == 0, F.concat(F.lit("40% Off Est. Retail $"), hi)).when(kind == 1, F.concat(F.lit("Est. Retail $"), hi)).otherwise(""),
        F.lit("\n~~Was: $9,000~~$12.00\n$"), lo, F.lit(".25"),
    )
    pair, rng = text.money_pair(single), text.money_range(double)
    return o.select(
        "o_orderkey", pair["currency"].alias("currency"), pair["amount"].alias("amount"),
        rng["currency"].alias("range_currency"), rng["low"].alias("low"), rng["high"].alias("high"),
        text.first_dollars(F.concat(F.lit("sold at $"), lo, F.lit(" or $1"))).alias("first_dollars"),
        text.last_cents(block).alias("last_cents"), text.retail_note(block).alias("retail"),
    )


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS from_seconds, strftime(ts, '%Y-%m-%d') AS from_millis,
       strftime(ts, '%Y-%m-%d') AS from_text, strftime(ts, '%Y-%m') AS from_path, CAST(NULL AS VARCHAR) AS from_junk FROM events"""
)
def parse_dates(spark, sf_dir):
    e = spread_table(spark, sf_dir, "events")
    secs = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return e.select(
        "event_id",
        dates.day_of_unix_seconds(secs).alias("from_seconds"),
        dates.day_of_unix_millis(secs * 1000).alias("from_millis"),
        dates.day_of_text(F.date_format("ts", "d MMMM yyyy")).alias("from_text"),
        dates.month_of_path(F.concat(F.lit("/auctions/"), F.date_format("ts", "yyyy/MM"), F.lit("/sale"))).alias("from_path"),
        dates.day_of_text(F.lit("soon")).alias("from_junk"),
    )


_SALE_COLS = "id, sold_price, currency_note, estimate_low, estimate_high"


@query(
    with_views(
        f"""
SELECT id, CASE WHEN currency_note <> 'USD' AND sold_price > 0 THEN ' (' || currency_note || ' ' || {comma_sql('sold_price')} || ')' ELSE '' END AS note,
       CASE WHEN currency_note <> 'USD' AND sold_price > 0 THEN ' (orig. ' || currency_note || ' ' || {comma_sql('sold_price')} || ')' ELSE '' END AS suffix
FROM sales""",
        SALES_SQL,
    )
)
def native_note(spark, sf_dir):
    amount, cur = F.col("sold_price"), F.col("currency_note")
    return sales(spark, sf_dir).select(
        "id", numbers.native_note(amount, cur).alias("note"), numbers.native_suffix(amount, cur).alias("suffix")
    )


@query(
    with_views(
        f"""
SELECT id, CASE WHEN sold_price IS NULL THEN 'n/a' ELSE '$' || {comma_sql('sold_price')} END AS money,
       CASE WHEN estimate_low IS NULL AND estimate_high IS NULL THEN '—'
            WHEN estimate_low IS NULL THEN '$' || {comma_sql('estimate_high')} WHEN estimate_high IS NULL THEN '$' || {comma_sql('estimate_low')}
            ELSE '$' || {comma_sql('estimate_low')} || '–$' || {comma_sql('estimate_high')} END AS estimate FROM sales""",
        SALES_SQL,
    )
)
def format_money(spark, sf_dir):
    return sales(spark, sf_dir).select(
        "id", numbers.money(F.col("sold_price")).alias("money"),
        numbers.estimate_text(F.col("estimate_low"), F.col("estimate_high")).alias("estimate"),
    )


@query("SELECT doc_id, md5(upper(substr(t, 1, 1)) || substr(t, 2)) AS text_md5 FROM (SELECT doc_id, lower(text) AS t FROM documents)")
def capitalize(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", F.md5(text.capital(F.lower("text"))).alias("text_md5"))


@query("SELECT event_id, greatest(50.0::DOUBLE, ceil(value * 1.15::DOUBLE / 50.0::DOUBLE) * 50.0::DOUBLE) AS axis FROM events")
def nice_ceil(spark, sf_dir):
    return spread_table(spark, sf_dir, "events").select("event_id", numbers.axis_ceiling(F.col("value"), 50).alias("axis"))


@query(
    with_views(
        """
SELECT 'a' || id AS id, CASE WHEN sold_price > 0 THEN 'Sold' WHEN estimate_low > 0 OR estimate_high > 0 THEN 'Estimate only' ELSE 'Unknown' END AS status FROM sales
UNION ALL SELECT 'd' || id, CASE WHEN status = 'active' THEN 'For sale' ELSE 'Delisted' END FROM listings""",
        SALES_SQL,
        LISTINGS_SQL,
    )
)
def derive_status(spark, sf_dir):
    a = sales(spark, sf_dir).select(
        F.concat(F.lit("a"), "id").alias("id"),
        text.auction_status(F.col("sold_price"), F.col("estimate_low"), F.col("estimate_high")).alias("status"),
    )
    d = listings(spark, sf_dir).select(F.concat(F.lit("d"), "id").alias("id"), text.dealer_status(F.col("status")).alias("status"))
    return a.unionByName(d)


@query(f"SELECT doc_id, CAST(len({TOKENS_SQL}) AS INTEGER) AS n_tokens, md5(array_to_string(list_sort({TOKENS_SQL}), ' ')) AS tokens FROM documents")
def tokenize(spark, sf_dir):
    tokens = text.title_tokens(F.col("text"))
    d = spread_table(spark, sf_dir, "documents").select("doc_id", tokens.alias("t"))
    return d.select("doc_id", F.size("t").alias("n_tokens"), F.md5(F.array_join(F.array_sort("t"), " ").cast("binary")).alias("tokens"))


@query(
    f"""
WITH t AS (SELECT doc_id, {TOKENS_SQL} AS tok FROM documents),
p AS (SELECT a.doc_id AS id_a, b.doc_id AS id_b, len(list_intersect(a.tok, b.tok)) AS shared, len(a.tok) AS na, len(b.tok) AS nb
      FROM t a JOIN t b ON b.doc_id = a.doc_id + 1)
SELECT id_a, id_b, CASE WHEN na = 0 OR nb = 0 THEN 0 ELSE CAST(shared AS DOUBLE) / (na + nb - shared) END AS sim FROM p"""
)
def jaccard(spark, sf_dir):
    d = spread_table(spark, sf_dir, "documents").select("doc_id", text.title_tokens(F.col("text")).alias("t"))
    a = d.select(F.col("doc_id").alias("id_a"), F.col("t").alias("ta"))
    b = d.select((F.col("doc_id") - 1).alias("id_a"), F.col("doc_id").alias("id_b"), F.col("t").alias("tb"))
    return a.join(b, "id_a").select("id_a", "id_b", text.jaccard(F.col("ta"), F.col("tb")).alias("sim"))


@query(
    """
WITH c AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS k FROM customer)
SELECT c_custkey, '+1212' || k AS ten, '+1212' || k AS eleven, '+44 20 ' || k AS plus, '+' || k AS short,
       '+1212' || k || ' +1313' || k AS list FROM c"""
)
def normalize_phone(spark, sf_dir):
    k = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    ten = F.concat(F.lit("(212) "), F.left(k, F.lit(3)), F.lit("-"), F.right(k, F.lit(4)))
    many = F.concat(ten, F.lit(" ; 1313"), k, F.lit(",,"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.phone_number(ten).alias("ten"),
        text.phone_number(F.concat(F.lit("1-"), ten)).alias("eleven"),
        text.phone_number(F.concat(F.lit("+44 20 "), k)).alias("plus"),
        text.phone_number(k).alias("short"),
        F.array_join(text.phone_list(many), " ").alias("list"),
    )


@query("SELECT doc_id, lang, source FROM documents WHERE regexp_matches(lower(concat_ws(' ', source, lang, text)), 'src1[0-9]?\\s*(en|fr)')")
def relevance_filter(spark, sf_dir):
    d = spread_table(spark, sf_dir, "documents")
    keep = text.brand_match(r"src1[0-9]?\s*(en|fr)", F.col("source"), F.col("lang"), F.col("text"))
    return d.where(keep).select("doc_id", "lang", "source")
