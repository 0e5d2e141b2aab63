"""Word lists, lookup tables, thresholds and patterns.

Results depend on these exact values. They are data, not logic.
"""

# --- thresholds -------------------------------------------------------------
PRICE_FLOOR = 50
NEW_DAYS = 7
CLOSED_DAYS = 28
CAPTURED_DAYS = 28
SALES_DAYS = 60
TOP_DEALERS = 20
TOP_NEW = 20
TOP_SALES = 5
TOP_TAGS = 15
TOP_FLAGS = 10
MIN_TAG_COUNT = 5
STATS_KEEP = 26
PAGE_SIZE = 50
ALERT_THRESHOLD = 5000
BACKFILL_SUSPECT = 10
ALERT_LONG = 15
ALERT_SHORT = 5
BACKFILL_COUNT = 10
MATCH_RATE_ALARM = 0.15
SAMPLE_NAMES = 8
MIN_CATEGORY_SAMPLE = 12
CATEGORY_PERCENTILE = 15
CATEGORY_RATIO = 0.25
GLOBAL_PERCENTILE = 5
PRICE_TOLERANCE = 0.1
MIN_TITLE_SIM = 0.3
MIN_SHARED_TOKENS = 1
STRONG_BITS = 10
LOOSE_BITS = 18
FEED_NOTE_CHARS = 300
MONEY_NOTE_CHARS = 1500
LANDING_CAP = 60
POST_DATA_CHARS = 4000

# --- price bands, half open -------------------------------------------------
PRICE_BANDS = [
    ("Under $5K", 0, 5000),
    ("$5K–$15K", 5000, 15000),
    ("$15K–$30K", 15000, 30000),
    ("$30K–$60K", 30000, 60000),
    ("$60K–$120K", 60000, 120000),
    ("$120K+", 120000, float("inf")),
]

# --- category rules, first match wins --
CATEGORY_RULES = {
    "A": [
        ("bracelet", r"bracelet|bangle|cuff(?!link)"),
        ("necklace", r"necklace|pendant|choker|collar|chain"),
        ("earrings", r"earring|ear clip|ear-clip"),
        ("brooch", r"brooch|pin\b|clip"),
        ("ring", r"ring\b"),
        ("cufflinks", r"cufflink"),
    ],
    "B": [
        ("bracelet", r"bracelet|bangle|cuff(?!link)"),
        ("necklace", r"necklace|pendant|choker|collar|chain"),
        ("earrings", r"earring|ear clip|ear-clip|earclip"),
        ("brooch", r"brooch|pin\b|clip"),
        ("ring", r"ring\b"),
        ("cufflinks", r"cufflink"),
    ],
    "C": [
        ("bracelet", r"bracelet|bangle|cuff(?!link)"),
        ("necklace", r"necklace|pendant|choker|collar|chain"),
        ("earrings", r"earring|ear clip|ear-clip|earclip|hoop|stud"),
        ("brooch", r"brooch|pin\b|clip\b"),
        ("ring", r"ring\b"),
        ("cufflinks", r"cufflink"),
    ],
}
OTHER_CATEGORY = "other"

# --- tag rules, in output order, case-insensitive -----------------------------
TAG_RULES = [
    ("Zodiac", r"zodiac|\baries\b|\btaurus\b|\bgemini\b|\bcancer\b|\bleo\b|\bvirgo\b|\blibra\b|\bscorpio\b|\bsagittarius\b|\bcapricorn\b|\baquarius\b|\bpisces\b"),
    ("Animal/Creature", r"\bfrog\b|\belephant\b|\bgiraffe\b|\bduck\b|\blion\b|\btiger\b|\bpanther\b|\bdragon\b|\bseahorse\b|\bfish\b|\bsnake\b|\bserpent\b|\bbird\b|\bowl\b|\bram\b|\bzebra\b|\bleopard\b|\bmonkey\b|\bturtle\b|\bcrab\b|\bscarab\b"),
    ("Fishscale", r"fish[\s-]?scale"),
    ("Hammered Gold", r"hammered"),
    ("Rock Crystal", r"rock\s*crystal"),
    ("Enamel", r"enamel"),
    ("Bombé", r"bomb[eé]"),
    ("Door Knocker", r"door\s*knocker"),
    ("Shell/Starfish", r"starfish|\bshell\b|\bscallop\b"),
    ("Maltese Cross", r"maltese"),
    ("Cuff/Bangle", r"\bcuff\b|\bbangle\b"),
    ("Carved Hardstone", r"\bcarved\b|\bcoral\b|\bturquoise\b|\bjade\b|\blapis\b"),
    ("Cabochon", r"cabochon"),
]
DECADE_PATTERN = r"\b(19[4-9]\d)s?\b"
ERA_PATTERN = r"\b(circa\s*)?(19\d0s|19\d{2}|20\d{2})\b"

# --- words left out of title tokens (the caller adds the words of the tracked brand) ---
STOP_WORDS = [
    "and", "a", "an", "the", "of", "with", "in", "18k", "18", "karat", "gold", "platinum", "14k",
    "carat", "carats", "ring", "rings", "earrings", "earclips", "clip", "clips", "clip-on", "necklace", "bracelet",
    "bracelets", "brooch", "brooches", "cufflinks", "pendant", "pendants", "hoop", "cocktail", "dome", "tie", "bar",
    "set", "diamond", "diamonds", "enamel", "vintage", "estate", "fine", "jewelry", "pair", "large", "small",
]
MIN_TOKEN_CHARS = 3

# --- US dollars for one unit of a currency, annual averages --------------------
FX_RATES = {
    "GBP": {
        1990: 1.786, 1991: 1.767, 1992: 1.766, 1993: 1.502, 1994: 1.531, 1995: 1.578, 1996: 1.562, 1997: 1.638,
        1998: 1.657, 1999: 1.618, 2000: 1.516, 2001: 1.440, 2002: 1.501, 2003: 1.635, 2004: 1.833, 2005: 1.820,
        2006: 1.843, 2007: 2.002, 2008: 1.853, 2009: 1.566, 2010: 1.546, 2011: 1.604, 2012: 1.585, 2013: 1.565,
        2014: 1.648, 2015: 1.528, 2016: 1.356, 2017: 1.289, 2018: 1.335, 2019: 1.277, 2020: 1.284, 2021: 1.376,
        2022: 1.237, 2023: 1.244, 2024: 1.278, 2025: 1.280, 2026: 1.300,
    },
    "CHF": {
        1996: 0.809, 1997: 0.697, 1998: 0.708, 1999: 0.677, 2000: 0.618, 2001: 0.591, 2002: 0.663, 2003: 0.744,
        2004: 0.805, 2005: 0.807, 2006: 0.797, 2007: 0.828, 2008: 0.928, 2009: 0.928, 2010: 0.958, 2011: 1.135,
        2012: 1.072, 2013: 1.081, 2014: 1.096, 2015: 1.045, 2016: 1.015, 2017: 1.016, 2018: 1.023, 2019: 1.006,
        2020: 1.064, 2021: 1.096, 2022: 1.043, 2023: 1.124, 2024: 1.136, 2025: 1.200, 2026: 1.268,
    },
    "EUR": {
        2002: 0.946, 2003: 1.131, 2004: 1.244, 2005: 1.244, 2006: 1.256, 2007: 1.371, 2008: 1.471, 2009: 1.394,
        2010: 1.327, 2011: 1.392, 2012: 1.286, 2013: 1.328, 2014: 1.329, 2015: 1.110, 2016: 1.107, 2017: 1.130,
        2018: 1.181, 2019: 1.119, 2020: 1.142, 2021: 1.183, 2022: 1.054, 2023: 1.082, 2024: 1.082, 2025: 1.080,
        2026: 1.163,
    },
    "HKD": {
        2000: 0.1284, 2004: 0.1284, 2006: 0.1287, 2011: 0.1286, 2015: 0.1290, 2018: 0.1276, 2019: 0.1276,
        2020: 0.1290, 2021: 0.1284, 2022: 0.1282, 2024: 0.1282, 2026: 0.1282,
    },
    "ITL": {
        1992: 0.000825, 1993: 0.000625, 1994: 0.000621, 1995: 0.000605, 1996: 0.000657, 1997: 0.000582, 1998: 0.000562,
    },
    "SGD": {1999: 0.5917, 2000: 0.5798, 2001: 0.5535},
}
FIRST_FX_YEAR = 1901

# --- web page patterns ----------------------------------------------------------
BLOCK_SIGNATURES = [
    "captcha-delivery.com", "DataDome Device Check", "Access to this page has been denied", "Press & Hold",
    "geo.captcha-delivery.com",
]
WALL_MARKERS = [
    "unusual traffic", "detected unusual traffic", "before you continue to google", "our systems have detected",
    "verify you're human", "verify you are human", "recaptcha",
]
SMALL_PAGE_CHARS = 5000
PLAIN_HEADERS = (
    r"(?i)^(accept|accept-encoding|accept-language|cache-control|connection|content-length|content-type|cookie|host"
    r"|origin|pragma|referer|sec-ch-ua|sec-ch-ua-mobile|sec-ch-ua-platform|sec-fetch-dest|sec-fetch-mode"
    r"|sec-fetch-site|user-agent|priority|te)$"
)
NOISE_HOSTS = (
    r"(?i)cookiebot|amplitude|sail-personalize|sail-track|openreplay|google-analytics|googletagmanager|doubleclick"
    r"|facebook\.net|hotjar|segment\.(io|com)|mixpanel|fullstory|sentry\.io|bugsnag"
)
CANDIDATE_BODY = (
    r'(?i)"(lots?|items?|hits?|results?|catalogs?|auctionlots?)"\s*:'
    r"|salePrice|priceResult|estimate\b|hammer\b|soldPrice|lotNumber"
)
PAGINATION_KEY = r"(?i)^(nb|total|num)[_-]?(hits|records|pages|results)$|^(page|hitsperpage|pagesize|perpage)$"
LOT_KEY = "lotnumber"
LOT_PRICE_KEYS = ["saleprice", "priceresult", "soldprice", "currentbid", "lowbidestimate"]
SEARCH_HOSTS = ["google.com", "gstatic.com"]
