"""Known cases of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from gavelkit.functions import dates, fx, numbers, prints, text
from gavelkit.params import Params


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize(
    "raw,expected",
    [
        ("https://www.A.example/x/", "www.a.example/x"),
        ("http://a.example:80/x?q=1#f", "a.example/x"),
        ("https://a.example:8443/x", "a.example:8443/x"),
        ("https://me:pw@a.example:443/X//", "a.example/x"),
        ("Not a url/?q", "not a url"),
        ("", ""),
        (None, ""),
    ],
)
def test_norm_url(spark, raw, expected):
    assert one(spark, text.norm_url(F.lit(raw).cast("string"))) == expected


def test_domain(spark):
    assert one(spark, text.domain_of(F.lit("https://www.Shop.example:8080/a"))) == "shop.example"
    assert one(spark, text.domain_of(F.lit("nonsense"))) == "nonsense"


@pytest.mark.parametrize(
    "title,variant,expected",
    [
        ("Gold Cufflinks", "A", "cufflinks"),
        ("Gold cuff", "A", "bracelet"),
        ("Gold Earclips", "A", "brooch"),
        ("Gold Earclips", "B", "earrings"),
        ("Diamond studs", "C", "earrings"),
        ("Spring", "A", "ring"),
        ("Ringed box", "A", "other"),
        (None, "A", "other"),
    ],
)
def test_category(spark, title, variant, expected):
    assert one(spark, text.category_of(F.lit(title).cast("string"), variant)) == expected


def test_tags_and_decade(spark):
    tags = text.tags_of(F.lit("BOMBÉ lion, carved coral"), F.lit("circa 1968"))
    assert one(spark, tags) == ["Animal/Creature", "Bombé", "Carved Hardstone", "1960s"]
    assert one(spark, text.tags_of(F.lit("fowls"), F.lit("1930"))) == []


def test_ascii_word_bounds(spark):
    # an accented letter is no word character
    assert one(spark, text.tags_of(F.lit("éowl"), F.lit(""))) == ["Animal/Creature"]


@pytest.mark.parametrize(
    "amount,currency,day,expected",
    [
        (11260000.0, "ITL", "1994-05-01", 6992.0),
        (100000.0, "HKD", "2013-01-01", 12860.0),
        (5000.0, "JPY", "2020-01-01", 5000.0),
        (99.5, " usd ", "2020", 100.0),
        (100.0, "GBP", "1950-01-01", 179.0),
        (100.0, "GBP", "", 130.0),
        (0.0, "USD", "2020", None),
        (float("nan"), "USD", "2020", None),
    ],
)
def test_usd(spark, amount, currency, day, expected):
    assert one(spark, fx.usd_price(F.lit(amount), F.lit(currency), F.lit(day), 2026)) == expected


def test_numbers(spark):
    assert one(spark, numbers.plausible(F.lit("49.99"))) is None
    assert one(spark, numbers.plausible(F.lit("50"))) == 50.0
    assert one(spark, numbers.positive(F.lit(float("inf")))) is None
    assert one(spark, numbers.round_half_up(F.lit(-2.5))) == -2
    assert one(spark, numbers.axis_ceiling(F.lit(494.0), 50)) == 600.0
    assert one(spark, numbers.money(F.lit(1234567.5))) == "$1,234,568"
    assert one(spark, numbers.locale_number(F.lit(1234.5))) == "1,234.5"
    assert one(spark, numbers.locale_number(F.lit(1200.0))) == "1,200"
    assert one(spark, numbers.plain_number(F.lit(1200.0))) == "1200"
    assert one(spark, numbers.minor_units(F.lit("12345"), F.lit(None))) == 123.45
    assert one(spark, numbers.price_gap(F.lit(90.0), F.lit(100.0))) == pytest.approx(0.1)


def test_entities(spark):
    raw = F.lit("&amp;lt; &#233;&#128142; &#38;#65; &quot;")
    assert one(spark, text.decode_entities(raw, "A")) == '&lt; &#233;&#128142; &#38;#65; "'
    assert one(spark, text.decode_entities(raw, "C")) == '< é💎 &#65; "'
    assert one(spark, text.decode_entities(F.lit("&AMP;&LT;"), "D")) == "&<"


def test_dates(spark):
    assert one(spark, dates.day_of_unix_seconds(F.lit(86400 * 365))) == "1971-01-01"
    assert one(spark, dates.day_of_text(F.lit("10 June 2026"))) == "2026-06-10"
    assert one(spark, dates.month_of_path(F.lit("auctions/2026/06/1"))) == "2026-06"
    # a partial date compares as text
    assert one(spark, dates.since(F.lit("2026-06"), "2026-06-18")) is False
    assert one(spark, dates.since(F.lit(None).cast("string"), "2026-06-18")) is False
    assert dates.days_before("2024-03-01", 1) == "2024-02-29"


def test_keys(spark):
    n = F.lit(None).cast("string")
    assert one(spark, text.listing_key(n, F.lit("Shop "), n, F.lit("A  Ring"))) == "meta:shop|a ring"
    assert one(spark, text.listing_key(n, F.lit("Shop"), F.lit("X1"), n)) == "sku:shop|x1"
    assert one(spark, text.sighting_key(n, F.lit("S"), F.lit("N"), F.lit("Asking"), F.lit(1200.0))) == "meta:s|n|asking|1200"


def test_prints(spark):
    grid = F.array(*[F.lit(float((i * 7) % 11)) for i in range(72)])
    bits = [1 if ((r * 9 + c) * 7) % 11 < ((r * 9 + c + 1) * 7) % 11 else 0 for r in range(8) for c in range(8)]
    word = sum(b << i for i, b in enumerate(bits))
    assert one(spark, prints.gradient_hash(grid, 9, 8)) % 2**64 == word
    assert one(spark, prints.hamming(F.lit(7).cast("bigint"), F.lit(-8).cast("bigint"))) == 64


def test_wide_prints(spark):
    grid = F.array(*[F.lit(float(i % 5)) for i in range(17 * 16)])
    words = one(spark, prints.gradient_words(grid, 17, 16))
    assert len(words) == 4
    assert one(spark, prints.hamming_words(prints.gradient_words(grid, 17, 16), F.array(*[F.lit(0).cast("bigint")] * 4))) == sum(
        bin(w % 2**64).count("1") for w in words
    )


def test_params_default_threshold():
    assert Params("2026-01-01", alert_threshold=0).alert_threshold == 5000
    assert Params("2026-01-01", alert_threshold=float("nan")).alert_threshold == 5000
