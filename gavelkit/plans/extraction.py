"""Registered queries: extraction jobs over payloads that Spark derives from the benchmark tables.

Each row of a table becomes one landed page with an item of the tracked brand and one that
must be left out. The SQL states the expected rows straight from the table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gavelkit.plans.adapters import spread_table, table
from gavelkit.plans.registry import Registry
from gavelkit.sources.extract import feeds, hits, html, state, text

query = Registry()
QUERIES, ORACLES = query.queries, query.oracles

lit, col = F.lit, F.col


def _s(name: str):
    return col(name).cast("string")


def _cat(*parts):
    return F.concat(*[p if not isinstance(p, str) else lit(p) for p in parts])


def _part(spark, sf_dir):
    return spread_table(spark, sf_dir, "part").withColumn("page", col("p_partkey"))


def _orders(spark, sf_dir):
    # a page is far larger than its row, and what sorts pages holds a task's
    o = spread_table(spark, sf_dir, "orders", rows=100_000, by="o_orderkey").withColumn("day", col("o_orderdate").cast("date").cast("string"))
    return o.withColumn("page", col("o_orderkey"))


def _page(rows, body):
    return rows.select("page", lit(0).alias("pos"), body.alias("body"))


_RING = "CASE WHEN p_name LIKE '%ring' THEN 'ring' ELSE 'other' END"


@query(
    f"""
SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS piece_name, {_RING} AS category,
       '19' || (50 + p_partkey % 50) AS era_or_year, p_retailprice AS asking_price, 'USD' AS currency_note,
       'https://shop.example.com/products/item-' || p_partkey AS listing_url, 'https://img.example.com/' || p_partkey AS image_url,
       'Fine & rare, made by ' || p_brand AS notes
FROM part WHERE p_brand LIKE 'Brand#1_'"""
)
def extract_shop_feed(spark, sf_dir):
    year = _cat("19", (50 + col("p_partkey") % 50).cast("string"))
    product = F.struct(
        col("p_partkey").alias("id"), _cat("item-", _s("p_partkey")).alias("handle"), col("p_name").alias("title"),
        col("p_brand").alias("vendor"), col("p_type").alias("product_type"), _cat("vintage, ", year).alias("tags"),
        _cat("<p>Fine &amp; rare,</p>\n<b>made by ", col("p_brand"), "</b>").alias("body_html"),
        F.array(F.struct(_cat("https://img.example.com/", _s("p_partkey")).alias("src"))).alias("images"),
        F.array(
            F.struct(_cat((col("p_retailprice") + 5).cast("string")).alias("price"), lit("").alias("sku")),
            F.struct(_s("p_retailprice").alias("price"), lit("b").alias("sku")),
            F.struct(lit("0.00").alias("price"), lit("c").alias("sku")),
        ).alias("variants"),
    )
    off = product.withField("vendor", lit("Somebody else")).withField("title", lit("plain thing"))
    pages = _page(_part(spark, sf_dir), F.to_json(F.struct(F.array(off, product).alias("products"))))
    out = feeds.shop_feed(pages, "shop.example.com", "Shop", "USD", r"brand#1\d$|brand#1\d ")
    return out.select(
        "sku", "piece_name", "category", "era_or_year", "asking_price", "currency_note", "listing_url", "image_url", "notes"
    )


@query(
    f"""
SELECT 'S-' || p_partkey AS sku, p_name || ' & co' AS piece_name, {_RING} AS category, p_retailprice * 100 / 1000.0::DOUBLE AS asking_price,
       'EUR' AS currency_note, 'https://store.example.com/p/' || p_partkey AS listing_url, 'thumb' AS image_url, 'short ' || p_brand AS notes
FROM part WHERE p_brand LIKE 'Brand#1_'"""
)
def extract_store_feed(spark, sf_dir):
    product = F.struct(
        col("p_partkey").alias("id"), _cat(col("p_name"), " &amp; co").alias("name"),
        _cat("https://store.example.com/p/", _s("p_partkey")).alias("permalink"), _cat("S-", _s("p_partkey")).alias("sku"),
        F.array(F.struct(col("p_brand").alias("name")), F.struct(lit("all").alias("name"))).alias("categories"),
        F.array(F.struct(lit("x").alias("name"))).alias("tags"),
        _cat("<i>short</i> ", col("p_brand")).alias("short_description"), lit("long").alias("description"),
        F.struct(
            F.round(col("p_retailprice") * 100, 0).cast("bigint").cast("string").alias("price"), lit("EUR").alias("currency_code"),
            lit(3).alias("currency_minor_unit"),
        ).alias("prices"),
        F.array(F.struct(lit("").alias("src"), lit("thumb").alias("thumbnail"))).alias("images"),
    )
    other = product.withField("categories", F.array(F.struct(lit("none").alias("name")))).withField("short_description", lit("no"))
    pages = _page(_part(spark, sf_dir), F.to_json(F.array(product, other)))
    out = feeds.store_feed(pages, "Store", r"brand#1\d\b")
    return out.select(
        "sku", "piece_name", "category", F.round("asking_price", 4).alias("asking_price"), "currency_note", "listing_url",
        "image_url", "notes",
    )


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_PAID = "CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice) END"
_LOW, _HIGH = "floor(o_totalprice / 2)", "floor(o_totalprice * 2)"
_KIND = "CASE WHEN o_orderstatus <> 'P' THEN 'hammer' ELSE 'estimate' END"


def _money_sql(x: str) -> str:
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def _prices():
    total = col("o_totalprice")
    paid = F.when(col("o_orderstatus") != "P", F.floor(total))
    return paid, F.floor(total / 2), F.floor(total * 2)


@query(
    f"""
SELECT 'Ring & pin ' || o_orderkey AS piece_name, 'brooch' AS category, CASE WHEN o_orderkey % 2 = 0 THEN '1965' ELSE '1970' END AS era_or_year,
       {_KIND} AS price_type, {_PAID} AS sold_price, {_LOW} AS estimate_low, strftime(o_orderdate, '%Y-%m') AS sale_date,
       CAST(o_custkey AS VARCHAR) AS lot_number, 'https://house.example.com/auctions/' || strftime(o_orderdate, '%Y/%m') || '/' || o_orderkey AS listing_url,
       CASE WHEN o_orderstatus <> 'P' THEN 'Premium price $' || {_money_sql(_HIGH)} || ' (incl. buyer''s premium) — ' ELSE '' END
         || 'a "fine" lot' || CASE WHEN o_orderstatus = 'P' THEN ' — Passed / unsold' ELSE '' END AS notes
FROM orders"""
)
def extract_attribute_state(spark, sf_dir):
    paid, low, high = _prices()
    item = F.struct(
        _cat("Ring & pin ", _s("o_orderkey")).alias("name"), paid.alias("result_amount"), high.alias("result_premium_amount"),
        low.cast("string").alias("estimate_low"), lit("").alias("estimate_high"),
        _cat("/auctions/", F.date_format("o_orderdate", "yyyy/MM"), "/", _s("o_orderkey")).alias("alias"),
        col("o_custkey").alias("lot_number"), F.when(col("o_orderkey") % 2 == 0, "1965").otherwise("").alias("year_designed"),
        lit("1970").alias("year_produced"), F.when(col("o_orderstatus") == "P", 1).otherwise(0).alias("passed_lot"),
        lit(' a "fine" lot ').alias("caption_brief"), F.struct(lit("Spring").alias("title")).alias("auction"),
    )
    data = F.struct(F.array(item).alias("data"), lit(1).alias("total"))
    nested = data.alias("items")
    for name in ("paginator", "primary_results", "results", "props"):
        nested = F.struct(nested).alias(name)
    state_text = F.replace(F.replace(F.to_json(F.struct(nested)), lit("&"), lit("&amp;")), lit('"'), lit("&quot;"))
    pages = _page(_orders(spark, sf_dir), _cat('<html><div id="app" data-page="', state_text, '"></div>'))
    out = html.attribute_state(pages, "House", "https://house.example.com")
    return out.select(
        "piece_name", "category", "era_or_year", "price_type", "sold_price", "estimate_low", "sale_date", "lot_number",
        "listing_url", "notes",
    )


@query(
    f"""
SELECT 'Gold cuff é ' || o_orderkey AS piece_name, 'bracelet' AS category, {_DAY} AS sale_date, 'Sale "A"' AS sale_name,
       CAST(o_orderkey AS VARCHAR) AS lot_number, 'https://cards.example.com/detail/maker/' || o_orderkey AS listing_url
FROM orders WHERE o_orderpriority = '1-URGENT'"""
)
def extract_list_cards(spark, sf_dir):
    card = lambda maker: _cat(
        '<li class="lot search-result-item wide" data-x="1">\n<a href=\'https://cards.example.com/detail/maker/', _s("o_orderkey"),
        '?from=search\'>\n<strong class="maker">', maker, "</strong><em>Gold cuff &#233; ", _s("o_orderkey"),
        "</em><span>Sale &quot;A&quot;</span><p>\n ", F.date_format("o_orderdate", "d MMMM yyyy"), " \n</p></a></li>\n",
    )
    body = _cat("<ul>", card(lit("Nobody")), card(col("o_orderpriority")), '<li class="other"><a href=\'x\'>no</a></li></ul>')
    out = html.list_cards(_page(_orders(spark, sf_dir), body), "Cards", "1-urgent")
    return out.select("piece_name", "category", "sale_date", "sale_name", "lot_number", "listing_url")


@query(
    f"""
SELECT 'EARCLIPS & ring' AS piece_name, 'earrings' AS category, {_KIND} AS price_type, {_PAID} AS sold_price,
       CAST({_LOW} AS DOUBLE) AS estimate_low, CAST({_HIGH} AS DOUBLE) AS estimate_high, 'USD' AS currency_note,
       CAST(o_orderkey AS VARCHAR) AS lot_number, 'https://split.example.com/auction/lot/?lot=' || o_orderkey || '&so=4' AS listing_url,
       o_orderpriority AS notes
FROM orders"""
)
def extract_split_cards(spark, sf_dir):
    paid, low, high = _prices()
    money = lambda c: _cat("$", F.format_number(c, 0))
    card = _cat(
        '<div class="auction-lot"><a href="/auction/lot/?lot=', _s("o_orderkey"), "&amp;so=4\">\n<span class='lot-title cat-3'>Lot ",
        _s("o_orderkey"), '<br />EARCLIPS &amp; ring</span><p><p class="stockfields-list">', col("o_orderpriority"), "</p></p>",
        F.coalesce(_cat("<strong>Sold for ", money(paid), "</strong>"), lit("")), "<strong>Estimated at ", money(low), " - ", money(high), "</strong>",
    )
    body = _cat("<a href=\"/skip\">x</a>", card, '<div class="auction-lot"><p>no title</p></div>')
    out = html.split_cards(_page(_orders(spark, sf_dir), body), "Split", "https://split.example.com")
    return out.select(
        "piece_name", "category", "price_type", "sold_price", "estimate_low", "estimate_high", "currency_note", "lot_number",
        "listing_url", "notes",
    )


@query(
    f"""
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'Line ' ELSE 'Title ' END || o_orderkey AS piece_name, {_KIND} AS price_type, {_PAID} AS sold_price,
       CAST({_LOW} AS DOUBLE) AS estimate_low, 'CHF' AS currency_note, {_DAY} AS sale_date, CAST(o_custkey AS VARCHAR) AS sale_name,
       'full text — Auction type: live — Location: Geneva, Paris' AS notes
FROM orders"""
)
def extract_search_hits(spark, sf_dir):
    paid, low, high = _prices()
    hit = F.struct(
        F.when(col("o_orderkey") % 2 == 0, _cat("Line ", _s("o_orderkey"))).otherwise("").alias("guaranteeLine"),
        _cat("Title ", _s("o_orderkey")).alias("title"), lit(" full text ").alias("fullText"),
        F.when(col("o_orderstatus") != "P", "SOLD").otherwise("OPEN").alias("soldStatus"), lit(0).alias("hammerPrice"),
        F.floor("o_totalprice").alias("salePrice"), low.alias("lowEstimate"), lit("CHF").alias("estimateCurrency"),
        (F.unix_date(col("o_orderdate").cast("date")).cast("bigint") * 86400000 + 3600000).alias("endDate"), col("o_custkey").alias("saleNumber"),
        lit("live").alias("auctionType"), F.array(lit("Geneva"), lit("Paris")).alias("auctionLocations"),
    )
    body = F.to_json(F.struct(F.array(F.struct(F.array(hit).alias("hits"), lit(1).alias("nbHits"))).alias("results")))
    out = hits.search_hits(_page(_orders(spark, sf_dir), body), "Hits")
    return out.select("piece_name", "price_type", "sold_price", "estimate_low", "currency_note", "sale_date", "sale_name", "notes")


@query(
    f"""
SELECT 'Brooch ' || o_orderkey AS piece_name, 'brooch' AS category, {_KIND} AS price_type, {_PAID} AS sold_price,
       CAST({_LOW} AS DOUBLE) AS estimate_low, CAST({_HIGH} AS DOUBLE) AS estimate_high,
       CASE WHEN o_orderstatus <> 'P' THEN 'USD' ELSE 'GBP' END AS currency_note, {_DAY} AS sale_date,
       'Sale ' || o_custkey || ' (Rome)' AS sale_name, 'A gem & gold' || CASE WHEN o_orderkey % 2 = 0 THEN ' — From a lady' ELSE '' END
         || CASE WHEN o_orderkey % 3 = 0 THEN ' — Lot withdrawn from sale' ELSE '' END AS notes
FROM orders"""
)
def extract_money_text_lots(spark, sf_dir):
    paid, low, high = _prices()
    n = lambda c: F.format_number(c, 0)
    lot = F.struct(
        _cat("Brooch ", _s("o_orderkey")).alias("title_primary_txt"), F.coalesce(_cat("USD ", n(paid)), lit("")).alias("price_realised_txt"),
        _cat("GBP ", n(low), " - ", n(high)).alias("estimate_txt"), _cat(col("day"), "T10:00:00").alias("start_date"),
        lit("https://lots.example.com/1").alias("url"), lit("<p>A gem &amp;amp;</p> gold").alias("description_txt"),
        F.when(col("o_orderkey") % 2 == 0, " From a lady ").otherwise("A gem & gold").alias("consigner_information"),
        (col("o_orderkey") % 3 == 0).alias("lot_withdrawn"), F.struct(_s("o_custkey").alias("number"), lit("Rome").alias("location")).alias("sale"),
    )
    lot = lot.withField("description_txt", lit("&lt;p&gt;A gem &amp;&lt;/p&gt; gold"))
    body = F.to_json(F.struct(F.array(lot).alias("lots"), lit(1).alias("total_pages")))
    out = hits.money_text_lots(_page(_orders(spark, sf_dir), body), "Lots")
    return out.select(
        "piece_name", "category", "price_type", "sold_price", "estimate_low", "estimate_high", "currency_note", "sale_date", "sale_name", "notes"
    )


@query(
    f"""
WITH d AS (SELECT o_orderkey AS page, 0 AS item, o_orderkey AS doc, o_totalprice AS p, {_DAY} AS day FROM orders
           UNION ALL SELECT o_orderkey, 1, o_orderkey + 1, o_totalprice, {_DAY} FROM orders)
SELECT 'Doc ' || doc AS piece_name, arg_min(floor(p), page * 2 + item) AS sold_price, arg_min(day, page * 2 + item) AS sale_date,
       'House' AS auction_house, CAST(doc AS VARCHAR) AS lot_number, 'Page ' || min(page * 2 + item) // 2 || ' & more — Department: Jewels' AS notes
FROM d GROUP BY doc"""
)
def extract_document_hits(spark, sf_dir):
    def hit(shift):
        doc = (col("o_orderkey") + shift).cast("string")
        return F.struct(
            F.struct(
                doc.alias("id"), _cat("Doc ", doc).alias("title"), lit("house").alias("brand"),
                F.struct(F.floor("o_totalprice").alias("hammerPrice")).alias("price"), F.struct(lit("HKD").alias("iso_code")).alias("currency"),
                F.struct((F.unix_date(col("o_orderdate").cast("date")).cast("bigint") * 86400 + 60).alias("timestamp")).alias("hammerTime"),
                F.struct(doc.alias("full")).alias("lotNo"), F.struct(lit("Jewels").alias("name")).alias("department"),
                _cat("<b>Page ", _s("o_orderkey"), "</b>&amp; more").alias("styledDescription"),
            ).alias("document")
        )

    body = F.to_json(F.struct(F.array(F.struct(F.array(hit(0), hit(1)).alias("hits"))).alias("results")))
    rows = _orders(spark, sf_dir)
    broken = _page(rows, lit('{"results": [')).withColumn("pos", lit(1))
    out = hits.document_hits(_page(rows, body).unionByName(broken), "Default")
    return out.select("piece_name", "sold_price", "sale_date", "auction_house", "lot_number", "notes")


@query(
    f"""
SELECT 'Lot & pin ' || o_orderkey AS piece_name, 'brooch' AS category, {_PAID} AS sold_price, {_DAY} AS sale_date, o_orderpriority AS auction_house,
       'by the 1-URGENT house' || CASE WHEN o_orderstatus = 'P' THEN ' — Current bid at capture: $' || {_money_sql(_LOW)} ELSE '' END AS notes
FROM orders WHERE o_orderpriority = '1-URGENT'"""
)
def extract_marked_hits(spark, sf_dir):
    paid, low, high = _prices()
    tag = "ais-highlight-0000000000"
    hit = F.struct(
        F.struct(F.struct(_cat(f" by the <{tag}>", col("o_orderpriority"), f"</{tag}> house ").alias("value")).alias("lotDescription")).alias("_highlightResult"),
        paid.alias("priceResult"), low.alias("estimateLow"), low.alias("currentBid"), lit("USD").alias("currencyCode"),
        (F.unix_date(col("o_orderdate").cast("date")).cast("bigint") * 86400).alias("dateTimeUTCUnix"), col("o_orderpriority").alias("houseName"),
        _cat("Lot &amp; pin ", _s("o_orderkey")).alias("lotTitle"),
    )
    body = F.to_json(F.struct(F.array(F.struct(F.array(hit).alias("hits"))).alias("results")))
    out = hits.marked_hits(_page(_orders(spark, sf_dir), body), "1-urgent")
    return out.select("piece_name", "category", "sold_price", "sale_date", "auction_house", "notes")


@query(
    f"""
SELECT 'Chain "{{x}}" ' || o_orderkey AS piece_name, 'necklace' AS category, {_KIND} AS price_type, {_PAID} AS sold_price, 'EUR' AS currency_note,
       {_DAY} AS sale_date, CAST(o_custkey AS VARCHAR) AS lot_number, 'https://state.example.com/item/' || o_orderkey || '_slug' AS listing_url,
       CASE WHEN o_orderstatus = 'P' THEN 'Passed / did not sell — ' ELSE '' END || 'Buy-now price $' || {_money_sql(_HIGH)}
         || CASE WHEN o_orderstatus = 'P' THEN ' — Leading bid at capture: $' || {_money_sql(_LOW)} ELSE '' END AS notes
FROM orders"""
)
def extract_page_state(spark, sf_dir):
    paid, low, high = _prices()
    lot = F.struct(
        col("o_orderkey").alias("itemId"), col("o_custkey").alias("lotNumber"), _cat('Chain "{x}" ', _s("o_orderkey")).alias("title"),
        lit("slug").alias("slug"), lit("Sale").alias("catalogTitle"), lit("Seller").alias("sellerName"), lit("EUR").alias("currency"),
        F.floor("o_totalprice").alias("salePrice"), high.alias("buyNowPrice"), low.alias("leadingBid"), low.alias("lowBidEstimate"),
        (col("o_orderstatus") != "P").alias("isSold"), (col("o_orderstatus") == "P").alias("isPassed"), lit(False).alias("isAvailable"),
        (F.unix_date(col("o_orderdate").cast("date")).cast("bigint") * 86400).alias("saleStartTs"),
    )
    summary = _cat('"itemSummary":{"byId":{"', _s("o_orderkey"), '":', F.to_json(lot), "}}")
    # a tenth of the pages is broken outside the part with the lots, another tenth goes on after the state
    broken = F.when(col("o_orderkey") % 10 == 0, ',"stats":Array.prototype').otherwise("")
    after = F.when(col("o_orderkey") % 10 == 1, ';window.other={"a":1}').otherwise("")
    body = _cat("<html><script>window.__data={", '"errorMessage":undefined,', summary, broken, "}", after, ";</script></html>")
    out = state.page_state(_page(_orders(spark, sf_dir), body), "__data", "https://state.example.com", "chain")
    return out.select("piece_name", "category", "price_type", "sold_price", "currency_note", "sale_date", "lot_number", "listing_url", "notes")


@query(
    """
SELECT 'j_' || p_partkey AS sku, p_name AS piece_name, p_retailprice AS asking_price, CASE WHEN p_partkey % 3 = 0 THEN 'A seller' ELSE p_brand END AS dealer,
       'https://market.example.com/id-' || p_partkey AS listing_url,
       CASE WHEN p_partkey % 2 = 0 THEN 'https://cdn.example.com' ELSE 'http://other.example.com' END || '/p' || p_partkey AS image_url
FROM part WHERE p_name LIKE 'red %'"""
)
def extract_object_store(spark, sf_dir):
    key = lambda kind, c: F.base64(F.encode(_cat(kind + ":", c), "UTF-8"))
    code = _cat("j_", _s("p_partkey"))
    ref = lambda k: F.struct(k.alias("__ref"))
    q = lambda k: _cat('"', k, '":')
    seller, profile, photo = key("Seller", _s("p_size")), key("Profile", _s("p_size")), key("Photo", _s("p_partkey"))
    tracking = F.struct(code.alias("id"), col("p_retailprice").alias("price"), col("p_name").alias("name"),
                        F.struct(lit(1).alias("EUR")).alias("convertedAmounts"))
    item = F.to_json(
        F.struct(tracking.alias("ecommerceTrackingParams"), _cat("/id-", _s("p_partkey")).alias("localizedPdpUrl"), ref(seller).alias("seller"),
                 F.struct(F.array(photo).alias("__refs")).alias("photos(limit:1)"))
    )
    company = F.when(col("p_partkey") % 3 != 0, col("p_brand"))
    path = _cat(F.when(col("p_partkey") % 2 == 0, "").otherwise("http://other.example.com"), "/p", _s("p_partkey"))
    body = _cat(
        "{", q(key("Item", code)), item, ",", q(seller), F.to_json(F.struct(ref(profile).alias("sellerProfile"))), ",",
        q(profile), F.to_json(F.struct(company.alias("company"))), ",", q(photo), F.to_json(F.struct(path.alias("masterOrZoomPath"))), "}",
    )
    out = state.object_store(_page(_part(spark, sf_dir), body), "https://market.example.com", "https://cdn.example.com", "A seller", "red ")
    return out.select("sku", "piece_name", "asking_price", "dealer", "listing_url", "image_url")


@query(
    f"""
SELECT p_name || ' ' || p_partkey AS piece_name, {_RING.replace("p_name LIKE '%ring'", "contains(p_name, ' ring')")} AS category,
       p_retailprice AS asking_price, 'USD' AS currency_note, 'Shop' AS dealer FROM part
UNION ALL SELECT 'Stud clip', 'brooch', 1200, 'GBP', 'Shop' FROM part"""
)
def extract_rendered_blocks(spark, sf_dir):
    body = _cat(
        "Menu\nThe Brand\n\n", col("p_name"), " ", _s("p_partkey"), "  \n\nBuy now\n\n", F.format_number("p_retailprice", 2),
        " USD\nThe Brand\n\nFree thing\n\nBuy now\n\n0 USD\n\nThe Brand\nStud clip\nBuy now\n1,200 GBP\nfooter",
    )
    out = text.rendered_blocks(_page(_part(spark, sf_dir), body), "The Brand", "Shop")
    return out.select("piece_name", "category", "asking_price", "currency_note", "dealer")


@query(
    """
SELECT p_name AS piece_name, CASE WHEN p_name LIKE '%ring' THEN 'ring' ELSE 'other' END AS category, p_retailprice AS asking_price,
       'https://md.example.com/products/' || p_partkey AS listing_url, 'https://img.example.com/last' AS image_url,
       '60% off Est. Retail $37,500' AS notes FROM part
UNION ALL SELECT 'Hoop', 'earrings', p_retailprice + 1, 'https://md.example.com/products/x' || p_partkey, NULL, 'Est. Retail $9,000' FROM part"""
)
def extract_markdown_blocks(spark, sf_dir):
    url = _cat("https://md.example.com/products/", _s("p_partkey"))
    other = _cat("https://md.example.com/products/x", _s("p_partkey"))
    shot = lambda img: _cat("[![Image 1: alt](https://img.example.com/", img, ")](", url, ")\n")
    body = _cat(
        "# page\n", shot("first"), "[Brand](", url, ")\n", col("p_name"), "\n60% Off Est. Retail $37,500\n$", F.format_number("p_retailprice", 2),
        "\n", shot("last"), "[Brand](", other, ")\nHoop\nEst. Retail $9,000\n~~Was: $8,500~~$", F.format_number(col("p_retailprice") + 1, 2),
        "\nNow 15% off\n[Brand](https://md.example.com/products/none)\nNo price\n$12\n",
    )
    out = text.markdown_blocks(_page(_part(spark, sf_dir), body), "Brand", "https://md.example.com", "Shop")
    return out.select("piece_name", "category", "asking_price", "listing_url", "image_url", "notes")


@query(
    """
WITH c AS (SELECT conv_id, turn, conv_id % 4 AS k FROM conversations)
SELECT conv_id, turn, 'piece ' || turn AS piece_name, CASE WHEN k = 3 THEN '' ELSE '12.5' END AS price, '' AS notes FROM c"""
)
def text_json_arrays(spark, sf_dir):
    c = spread_table(spark, sf_dir, "conversations")
    k = col("conv_id") % 4
    array = _cat('[{"piece_name": "piece ', _s("turn"), '", "price": 12.5}, 7]')
    short = _cat('[{"piece_name": "piece ', _s("turn"), '", "note": "a ] in text"}]')
    # bare, fenced, inside prose, and between other brackets
    reply = (
        F.when(k == 0, array)
        .when(k == 1, _cat("```json\n", array, "\n```"))
        .when(k == 2, _cat(F.replace(F.replace("text", lit("["), lit("(")), lit("]"), lit(")")), " Here: ", array, " as asked."))
        .otherwise(_cat("see [the list: ] ", short, " and [more"))
    )
    block = lambda t: F.struct(lit("text").alias("type"), t.alias("text"))
    body = F.to_json(F.struct(F.array(block(lit("thinking aloud")), F.struct(lit("tool").alias("type"), lit("[1]").alias("text")), block(reply)).alias("content")))
    rows = c.select("conv_id", "turn", body.alias("body"))
    out = text.reply_items(rows, ["piece_name", "price", "notes"])
    return out.select("conv_id", "turn", "piece_name", "price", "notes")
