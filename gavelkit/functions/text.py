"""Text, markup, urls, keys, categories and tags."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gavelkit.functions import fixed
from gavelkit.functions.numbers import blank_to_null, plain_number, positive

_NOT_WORD_BEFORE = r"(?<![A-Za-z0-9_])"
_NOT_WORD_AFTER = r"(?![A-Za-z0-9_])"


def ascii_bounds(pattern: str) -> str:
    """Replace ``\\b`` by look-arounds that treat only ASCII as word characters.

    A ``\\b`` that opens an alternative looks behind, any other looks ahead.
    """
    out, i = [], 0
    while i < len(pattern):
        if pattern.startswith(r"\b", i):
            opens = i == 0 or pattern[i - 1] in "|("
            out.append(_NOT_WORD_BEFORE if opens else _NOT_WORD_AFTER)
            i += 2
        else:
            out.append(pattern[i])
            i += 1
    return "".join(out)


def word_pattern(pattern: str) -> str:
    """A case-insensitive pattern in which all whole-word alternatives share one boundary test."""
    parts = pattern.split("|") if "(" not in pattern else [pattern]
    words = [p[2:-2] for p in parts if re.fullmatch(r"\\b[A-Za-z]+\\b", p)]
    rest = [ascii_bounds(p) for p in parts if not re.fullmatch(r"\\b[A-Za-z]+\\b", p)]
    if words:
        rest.append(f"{_NOT_WORD_BEFORE}(?:{'|'.join(words)}){_NOT_WORD_AFTER}")
    # only a pattern with accents needs the slower folding of all letters
    return ("(?i)" if pattern.isascii() else "(?iu)") + "|".join(rest)


def tidy(c: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def one_spaced(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def text_or(c: Column, default: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def capital(c: Column) -> Column:
    """Upper-case the first letter only."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def join_parts(*parts: Column, sep: str = " — ") -> Column:
    """The non-empty parts, joined."""
    return F.concat_ws(sep, *[blank_to_null(p) for p in parts])


# --- urls -------------------------------------------------------------------
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+"


def _authority_and_path(raw: Column) -> Column:
    body = F.regexp_extract(raw, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^?#]*)", 1)
    body = F.regexp_replace(body, r"^[^/@]*@", "")
    scheme = F.lower(F.regexp_extract(raw, r"^([A-Za-z][A-Za-z0-9+.\-]*)://", 1))
    body = F.when(scheme == "http", F.regexp_replace(body, r"^([^/:]*):80(?=/|$)", "$1")).otherwise(body)
    return F.when(scheme == "https", F.regexp_replace(body, r"^([^/:]*):443(?=/|$)", "$1")).otherwise(body)


def norm_url(url: Column) -> Column:
    """Host and path in lower case, without scheme, query, fragment and closing slashes."""
    raw = tidy(F.coalesce(url, F.lit("")))
    parsed = F.lower(_authority_and_path(raw))
    loose = F.regexp_replace(F.lower(raw), r"[?#][\s\S]*$", "")
    return F.regexp_replace(F.when(raw.rlike(_ABSOLUTE), parsed).otherwise(loose), r"/+$", "")


def domain_of(url: Column) -> Column:
    """The host without a leading ``www.``; the raw value if it is no url."""
    raw = F.coalesce(url, F.lit(""))
    host = F.regexp_replace(F.regexp_replace(_authority_and_path(tidy(raw)), r"/[\s\S]*$", ""), r":\d+$", "")
    return F.when(tidy(raw).rlike(_ABSOLUTE), F.regexp_replace(F.lower(host), r"^www\.", "")).otherwise(raw)


def _part(c: Column) -> Column:
    return tidy(F.lower(F.coalesce(c.cast("string"), F.lit(""))))


def _name_part(c: Column) -> Column:
    return tidy(one_spaced(F.lower(F.coalesce(c, F.lit("")))))


def auction_key(url: Column, house: Column, lot: Column, sale_date: Column, name: Column) -> Column:
    u = norm_url(url)
    meta = F.concat_ws("|", _part(house), _part(lot), tidy(F.coalesce(sale_date, F.lit(""))), _name_part(name))
    return F.when(u != "", F.concat(F.lit("url:"), u)).otherwise(F.concat(F.lit("meta:"), meta))


def listing_key(url: Column, dealer: Column, sku: Column, name: Column) -> Column:
    u = norm_url(url)
    return (
        F.when(u != "", F.concat(F.lit("url:"), u))
        .when(blank_to_null(sku).isNotNull(), F.concat(F.lit("sku:"), _part(dealer), F.lit("|"), _part(sku)))
        .otherwise(F.concat(F.lit("meta:"), _part(dealer), F.lit("|"), _name_part(name)))
    )


def sighting_key(url: Column, site: Column, name: Column, price_type: Column, price: Column) -> Column:
    u = norm_url(url)
    meta = F.concat_ws(
        "|",
        _part(site),
        _name_part(name),
        F.lower(F.coalesce(price_type, F.lit(""))),
        plain_number(F.coalesce(price.try_cast("double"), F.lit(0.0))),
    )
    return F.when(u != "", F.concat(F.lit("url:"), u)).otherwise(F.concat(F.lit("meta:"), meta))


# --- markup -----------------------------------------------------------------
# fixed values: the entities of each decoder, in the order they are replaced
_ENTITIES_A = [("&quot;", '"'), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]
_ENTITIES_B = [("&amp;", "&"), ("&quot;", '"'), ("&#039;", "'"), ("&lt;", "<"), ("&gt;", ">")]
_ENTITIES_D = [("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"), ("&quot;", '"'), ("&#039;", "'")]


def _replace_all(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, c)


def _numeric_entities(c: Column) -> Column:
    """``&#233;`` and the like, in one pass, any code point."""
    codes = F.regexp_extract_all(c, F.lit(r"&#(\d+);"), F.lit(1))
    chars = F.transform(
        codes,
        lambda d: F.decode(F.unhex(F.lpad(F.hex(d.try_cast("bigint")), 8, "0")), "UTF-32"),
    )
    pieces = F.split(c, r"&#\d+;")
    merged = F.array_join(F.zip_with(pieces, chars, lambda p, ch: F.concat(p, F.coalesce(ch, F.lit("")))), "")
    return F.when(F.size(codes) == 0, c).otherwise(merged)


def decode_entities(c: Column, variant: str = "A") -> Column:
    """Decode entities. A decodes once, B twice, C numeric codes first, D ignores case."""
    c = F.coalesce(c, F.lit(""))
    if variant == "A":
        return _replace_all(c, _ENTITIES_A)
    if variant == "B":
        return _replace_all(c, _ENTITIES_B)
    if variant == "C":
        return tidy(_replace_all(_numeric_entities(c), _ENTITIES_B))
    if variant == "D":
        return reduce(lambda acc, p: F.regexp_replace(acc, f"(?i){p[0]}", p[1]), _ENTITIES_D, c)
    raise ValueError(f"unknown decoder {variant}")


def strip_tags(c: Column, variant: str = "A") -> Column:
    """Plain text. A strips, then decodes; B decodes, then strips; C decodes three entities only."""
    c = F.coalesce(c, F.lit(""))
    if variant == "A":
        plain = decode_entities(F.regexp_replace(c, r"<[^>]*>", " "), "A")
    elif variant == "B":
        plain = F.regexp_replace(decode_entities(c, "D"), r"<[^>]*>", " ")
    elif variant == "C":
        plain = _replace_all(
            F.regexp_replace(c, r"<[^>]+>", " "), [("&amp;", "&"), ("&quot;", '"'), ("&#039;", "'")]
        )
    else:
        raise ValueError(f"unknown variant {variant}")
    return tidy(one_spaced(plain))


def page_text(html: Column) -> Column:
    """Page text without scripts and tags, spaces collapsed."""
    bare = F.regexp_replace(html, r"(?i)<script[\s\S]*?</script>", "")
    return one_spaced(F.regexp_replace(bare, r"<[^>]+>", " "))


# --- enrichment -------------------------------------------------------------
def category_of(text: Column, variant: str = "A", rules: list[tuple[str, str]] | None = None) -> Column:
    """The first category whose rule matches."""
    low = F.lower(F.coalesce(text, F.lit("")))
    chain = F
    for name, pattern in rules or fixed.CATEGORY_RULES[variant]:
        chain = chain.when(low.rlike(ascii_bounds(pattern)), F.lit(name))
    return chain.otherwise(F.lit(fixed.OTHER_CATEGORY))


def era_of(text: Column) -> Column:
    return F.trim(F.regexp_extract(F.coalesce(text, F.lit("")), "(?i)" + ascii_bounds(fixed.ERA_PATTERN), 0))


def decade_of(era: Column) -> Column:
    """The decade of the first year from 1940 to 1999, else null."""
    year = F.regexp_extract(F.coalesce(era, F.lit("")), ascii_bounds(fixed.DECADE_PATTERN), 1)
    return F.when(year != "", F.concat(F.substring(year, 1, 3), F.lit("0s")))


def rule_tags(text: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The tags whose rules match, in rule order."""
    hay = F.coalesce(text, F.lit(""))
    return F.array_compact(F.array(*[F.when(hay.rlike(word_pattern(p)), F.lit(tag)) for tag, p in rules or fixed.TAG_RULES]))


def with_decade(tags: Column, era: Column) -> Column:
    """Tags, then the decade of the era; where the tags belong to a small table they are found there, before a join."""
    return F.concat(tags, F.array_compact(F.array(decade_of(era))))


def tags_of(text: Column, era: Column, rules: list[tuple[str, str]] | None = None) -> Column:
    """The tags whose rules match, in rule order, then the decade."""
    return with_decade(rule_tags(text, rules), era)


def split_tags(c: Column) -> Column:
    """Tags of a joined text, split at semicolons and trimmed."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ";"), tidy), lambda t: t != "")


def brand_match(pattern: str, *parts: Column) -> Column:
    """Whether any part mentions the brand; parts are joined with a space."""
    return F.concat_ws(" ", *[blank_to_null(p) for p in parts]).rlike("(?i)" + pattern)


def title_tokens(name: Column, extra_stop_words: tuple[str, ...] = ()) -> Column:
    """The distinct words of a title: ASCII letters and digits, three or more, no stop words."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^a-z0-9]+", " "), " ")
    stop = [*fixed.STOP_WORDS, *extra_stop_words]
    keep = F.filter(words, lambda w: (F.length(w) >= fixed.MIN_TOKEN_CHARS) & ~w.isin(*stop))
    return F.array_distinct(keep)


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two token sets; zero if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(shared / either)


# --- status and labels --------------------------------------------------------
def auction_status(sold: Column, low: Column, high: Column) -> Column:
    has = lambda c: c.isNotNull() & (c != 0)
    return F.when(has(sold), "Sold").when(has(low) | has(high), "Estimate only").otherwise("Unknown")


def dealer_status(status: Column) -> Column:
    return F.when(status == "active", "For sale").otherwise("Delisted")


def link_text(name: Column, url: Column) -> Column:
    """A markdown link, or the bare name where no url is known."""
    label = text_or(name, "(untitled)")
    return F.when(
        blank_to_null(url).isNotNull(), F.concat(F.lit("["), label, F.lit("]("), url, F.lit(")"))
    ).otherwise(label)


def verdict_of(reply: Column) -> Column:
    """The verdict that opens a judge's reply."""
    t = tidy(F.coalesce(reply, F.lit("")))
    return F.when(t.rlike("(?i)^same"), "SAME").when(t.rlike("(?i)^different"), "DIFFERENT").otherwise("UNCLEAR")


def phone_number(c: Column) -> Column:
    """The international form of a phone number."""
    raw = F.coalesce(c, F.lit(""))
    digits = F.regexp_replace(raw, r"[^0-9]", "")
    plus = F.concat(F.lit("+"), digits)
    return (
        F.when(F.length(digits) == 10, F.concat(F.lit("+1"), digits))
        .when((F.length(digits) == 11) & digits.startswith("1"), plus)
        .when(raw.startswith("+"), raw)
        .otherwise(plus)
    )


def phone_list(c: Column) -> Column:
    """The numbers of a list split at commas and semicolons."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), "[,;]"), tidy)
    return F.transform(F.filter(parts, lambda p: p != ""), phone_number)


def money_pair(c: Column) -> Column:
    """``USD 7,698,500`` as struct(currency, amount); null fields if the text differs."""
    p = r"^([A-Z]{3})\s+([\d,]+(?:\.\d+)?)$"
    t = tidy(F.coalesce(c, F.lit("")))
    amount = F.replace(F.regexp_extract(t, p, 2), F.lit(","), F.lit("")).try_cast("double")
    return F.struct(
        F.when(amount.isNotNull(), F.regexp_extract(t, p, 1)).alias("currency"), amount.alias("amount")
    )


def money_range(c: Column) -> Column:
    """``USD 3,000 - 5,000`` as struct(currency, low, high)."""
    p = r"^([A-Z]{3})\s+([\d,]+)\s*-\s*([\d,]+)$"
    t = tidy(F.coalesce(c, F.lit("")))
    low = F.replace(F.regexp_extract(t, p, 2), F.lit(","), F.lit("")).try_cast("double")
    high = F.replace(F.regexp_extract(t, p, 3), F.lit(","), F.lit("")).try_cast("double")
    ok = low.isNotNull() & high.isNotNull()
    return F.struct(
        F.when(ok, F.regexp_extract(t, p, 1)).alias("currency"),
        F.when(ok, low).alias("low"),
        F.when(ok, high).alias("high"),
    )


def first_dollars(c: Column) -> Column:
    """The first ``$`` figure, thousands separators removed."""
    plain = F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(""))
    return F.regexp_extract(plain, r"\$(\d+(?:\.\d+)?)", 1).try_cast("double")


def last_cents(c: Column) -> Column:
    """The last ``$`` figure that carries cents."""
    figures = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\$([\d,]+\.\d{2})"), F.lit(1))
    return F.replace(F.try_element_at(figures, F.lit(-1)), F.lit(","), F.lit("")).try_cast("double")


def retail_note(c: Column) -> Column:
    """The retail estimate, with the discount if one is stated."""
    off = r"(\d+)%\s*Off Est\. Retail \$([\d,]+)"
    plain = r"Est\. Retail \$([\d,]+)"
    pct, was, est = F.regexp_extract(c, off, 1), F.regexp_extract(c, off, 2), F.regexp_extract(c, plain, 1)
    return (
        F.when(pct != "", F.concat(pct, F.lit("% off Est. Retail $"), was))
        .when(est != "", F.concat(F.lit("Est. Retail $"), est))
        .otherwise("")
    )


def price_or_zero(c: Column) -> Column:
    return F.coalesce(positive(c), F.lit(0.0))
