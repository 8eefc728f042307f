"""Patterns, word lists and parameters that results depend on.

Everything here is data.  Patterns are written without flags; the text functions add Java's flags,
the SQL twins add RE2's.
"""

from __future__ import annotations

# --- fixed values: field patterns of the raw catalog text ("labelled" extraction) ---
ITEM_NAME_OR_EMPTY = r"Item Name:\s*([^\n]*)"
VALUE = r"Value:\s*([\d.]+)"
PACK_OR_COUNT = r"(?:Pack|Count)[:\s]*(\d+)"
BULLET_OR_DESCRIPTION = r"(?:Bullet Point|Description).*?:\s*([^\n]+)"
CLEAN_TEXT_CHARS = 500

# --- fixed values: cuts of a small trial, to be asked for by name; the library reads whole texts without them ---
TRIAL_CUTS = {"max_chars": 2000, "max_name_chars": 200, "max_parts": 5}
TRIAL_COMBINED_CHARS = 1000
TRIAL_SENTIMENT_CHARS = 200

# --- fixed values: field patterns of the detailed extraction ---
ITEM_NAME = r"Item Name:\s*([^\n]+)"
BULLET_POINT = r"Bullet Point \d+:\s*([^\n]+)"
PRODUCT_DESCRIPTION = r"Product Description:\s*([^\n]+)"
UNIT = r"Unit:\s*([^\n]+)"
WEIGHT = r"(\d+(?:\.\d+)?)\s*(oz|lb|g|kg)\b"
PACK_OF_OR_COUNT = r"(?:Pack\s*of\s*|Count[:\s]*)(\d+)"

# --- fixed values: category keywords, matched as substrings of the lower-cased text ---
CATEGORY_KEYWORDS = {
    "food": ["food", "snack", "eat", "beverage"],
    "electronics": ["electronic", "battery", "digital"],
    "beauty": ["beauty", "cosmetic", "skin"],
    "home": ["home", "kitchen", "decor"],
    "health": ["health", "vitamin", "supplement"],
}

# --- fixed values: tokens of the text vectoriser ---
TOKEN = r"[\p{L}\p{N}_]{2,}"

# --- fixed values: default price of a brand never seen, when the data carries no price ---
UNSEEN_BRAND_PRICE = 50.0

# --- fixed values: smallest denominator of the percentage errors, and of the blend weights ---
ZERO_DENOMINATOR = 1e-8
WEIGHT_EPSILON = 1e-6

# --- fixed values: columns that are never features ---
NON_FEATURES_BLEND = ["sample_id", "catalog_content", "price", "item_name", "description", "brand"]
NON_FEATURES_STACK = [
    "sample_id", "catalog_content", "catalog_content_clean", "price", "item_name", "bullet_points_text",
    "product_description", "brand", "unit", "brand_filled", "image_link",
]

# --- fixed values: English function words a vectoriser drops; the Snowball project's English list (BSD) without
# one-letter words and contractions, and with "cannot could would ought" ---
ENGLISH_STOP_WORDS = """
me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it
its itself they them their theirs themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such no nor not only own same so
than too very can will just don should now cannot could ought would
""".split()

# --- fixed values: polarity and subjectivity of some words of product English, rounded to two places from the English
# sentiment lexicon of the pattern library (BSD), which TextBlob (MIT) uses too; pass another lexicon for more words ---
SENTIMENT_LEXICON = {
    "amazing": (0.6, 0.9), "awesome": (1.0, 1.0), "awful": (-1.0, 1.0), "bad": (-0.7, 0.67),
    "beautiful": (0.85, 1.0), "best": (1.0, 0.3), "better": (0.5, 0.5), "big": (0.0, 0.1),
    "bright": (0.7, 0.8), "broken": (-0.4, 0.4), "cheap": (0.4, 0.7), "clean": (0.37, 0.7),
    "cold": (-0.6, 1.0), "comfortable": (0.4, 0.8), "cool": (0.35, 0.65), "delicious": (1.0, 1.0),
    "difficult": (-0.5, 1.0), "dirty": (-0.6, 0.8), "easy": (0.43, 0.83), "elegant": (0.5, 1.0),
    "excellent": (1.0, 1.0), "expensive": (-0.5, 0.7), "fine": (0.42, 0.5), "fresh": (0.3, 0.5),
    "good": (0.7, 0.6), "great": (0.8, 0.75), "happy": (0.8, 1.0), "hard": (-0.29, 0.54),
    "heavy": (-0.2, 0.5), "large": (0.21, 0.43), "light": (0.4, 0.7), "lovely": (0.5, 0.75),
    "natural": (0.1, 0.4), "new": (0.14, 0.45), "nice": (0.6, 1.0), "old": (0.1, 0.2),
    "perfect": (1.0, 1.0), "poor": (-0.4, 0.6), "premium": (0.3, 0.5),
    "pure": (0.21, 0.5), "rich": (0.38, 0.75), "sad": (-0.5, 1.0), "safe": (0.5, 0.5),
    "simple": (0.0, 0.36), "small": (-0.25, 0.4), "smooth": (0.4, 0.5), "soft": (0.1, 0.35),
    "special": (0.36, 0.57), "strong": (0.43, 0.73), "super": (0.33, 0.67), "sweet": (0.35, 0.65),
    "terrible": (-1.0, 1.0), "ugly": (-0.7, 1.0), "warm": (0.6, 0.6), "weak": (-0.38, 0.63),
    "wonderful": (1.0, 1.0), "worst": (-1.0, 1.0), "wrong": (-0.5, 0.9),
}

# --- fixed values: words that turn the next word of a sentiment around, and factors that adverbs put on it ---
NEGATIONS = ("no", "not", "never", "without", "neither", "nor", "cannot")
INTENSITIES = {
    "absolutely": 1.5, "barely": 0.5, "completely": 1.4, "especially": 1.3, "exceptionally": 1.5, "extremely": 1.5,
    "fairly": 0.9, "highly": 1.3, "incredibly": 1.5, "mildly": 0.6, "moderately": 0.8, "most": 1.3, "pretty": 1.1,
    "quite": 1.1, "rather": 0.9, "really": 1.3, "slightly": 0.6, "so": 1.2, "somewhat": 0.7, "too": 1.2,
    "totally": 1.4, "truly": 1.3, "very": 1.3,
}
