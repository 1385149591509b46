"""Fixed values that must equal the original review tool's for equal results.

The rule patterns, tag names, kept negations, placeholder text, page
layouts and URL prefixes below come from an MIT-licensed review-scraping
and classification tool (MIT License; permission notice: "The above copyright
notice and this permission notice shall be included in all copies or
substantial portions of the Software.").  They are data, stated verbatim and
in their original order.  The stopword list is the public English stopword
corpus shipped with NLTK.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: issue tags and rule dictionary (tag -> regular expression).
# Patterns are matched against the lower-cased title and, separately, the
# lower-cased body; there are no word boundaries on purpose.
# ---------------------------------------------------------------------------
DEFAULT_TAGS = [
    "sound",
    "no cooling",
    "condensate drain issues",
    "8.8 error code",
    "missing parts",
    "used unit",
    "wifi",
]

RULES = [
    ("8.8 error code", "blink.+?88|beep.+?88|flash.+?88|88.+?error|8\\.8"),
    ("sound", "nois|loud|buzz|rattl|sound[a-z\\s]+like|make[a-z\\s]+sound"),
    ("missing parts", "missing|(?:not|n't|n’t)[a-z\\s]+(?:come|receive|contain|include)"),
    ("used unit", "used\\s+(?:unit|item)|(?:be|was|were)[a-z\\s]+used|previous\\s+return|repackage|restock"),
    ("wifi", "wifi|wi-fi"),
]

# Tags of the training entry point.
TRAIN_TAGS = ["no cooling", "condensate drain issues"]

# Body text that never gets a model label.
PLACEHOLDER_BODY = "Rating provided by a verified purchaser"

# ---------------------------------------------------------------------------
# FIXED VALUES: English stopwords (NLTK corpus, 179 words) and the negations
# that are kept.  Apostrophe forms can never survive the letters-only
# cleaning step, so they are listed for completeness only.
# ---------------------------------------------------------------------------
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in out
on off over under again further then once here there when where why how all any both each few more most other some such
no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't
mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

KEPT_NEGATIONS = ["not", "no", "don", "don't", "aren", "aren't", "didn", "didn't", "doesn", "doesn't", "isn", "isn't"]

STOPWORDS = [w for w in ENGLISH_STOPWORDS if w not in KEPT_NEGATIONS]
# Only letters and spaces are left after cleaning, so these are the words
# that can actually occur.
EFFECTIVE_STOPWORDS = [w for w in STOPWORDS if "'" not in w]

# Contractions the Treebank word tokenizer splits even without apostrophes.
TOKENIZER_SPLITS = [
    ("cannot", "can not"),
    ("gimme", "gim me"),
    ("gonna", "gon na"),
    ("gotta", "got ta"),
    ("lemme", "lem me"),
    ("wanna", "wan na"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: vectorizer and classifier settings.
# ---------------------------------------------------------------------------
MAX_FEATURES = 300          # top terms by corpus count, unigrams + bigrams
MIN_TOKEN_LEN = 2           # the vectorizer's default token pattern keeps words of 2+ chars
NB_ALPHA = 1.0              # Laplace smoothing of term probabilities; the prior is not smoothed

# ---------------------------------------------------------------------------
# FIXED VALUES: page layouts (class names / data-hook values) and formats.
# ---------------------------------------------------------------------------
AMAZON = {
    "review": ("div", "data-hook", "review"),
    "date": ("span", "data-hook", "review-date"),
    "size": ("a", "data-hook", "format-strip"),
    "rating": ("i", "data-hook", "review-star-rating"),
    "title": ("a", "data-hook", "review-title"),
    "body": ("span", "data-hook", "review-body"),
    "image": ("img", "data-hook", "review-image-tile"),
    "badge": ("span", "data-hook", "avp-badge"),
}
HOMEDEPOT = {
    "review": ("div", "class", "review_item"),
    "pager": ("span", "class", "pager-summary__bold"),
    "date": ("span", "class", "review-content__date"),
    "stars": ("span", "class", "stars"),
    "title": ("span", "class", "review-content__title"),
    "body": ("div", "class", "review-content-body"),
    "media": ("div", "class", "media-carousel__media"),
    "heading": ("h1", "class", "page-title"),
    "detail": ("h2", "class", "product-info-bar__detail--24WIp"),
    "pod": ("div", "class", "browse-search__pod"),
    "ratings_count": ("span", "class", "product-pod__ratings-count"),
}
WALMART = {
    "grid_item": ("div", "class", "Grid-col u-size-6-12 u-size-1-4-m u-size-1-5-xl"),
    "reviews_count": ("span", "class", "stars-reviews-count"),
    "wrapper": ("div", "class", "search-result-gridview-item-wrapper"),
}

SIZE_LABEL = "Size: "
HOMEDEPOT_REVIEW_PREFIX = "https://www.homedepot.com/p/reviews"
LOWES_SEARCH_URL = ("https://www.lowes.com/rnr/r/get-by-product/{}/pdp/prod"
                    "?sortMethod=SubmissionTime&sortDirection=desc&offset=")
LOWES_PAGE_SIZE = 10

# Model-number features on a spec table, by priority.
MODEL_FEATURE = "Model"
PART_NUMBER_FEATURES = ["Manufacturer Part Number", "manufacturer_part_number"]

# Built-in category -> listing URL tables.
CATEGORY_URLS = {
    "homedepot": {
        "Window": "https://www.homedepot.com/b/Heating-Venting-Cooling-Air-Conditioners-Window-Air-Conditioners/N-5yc1vZc4lu",
        "Portable": "https://www.homedepot.com/b/Heating-Venting-Cooling-Air-Conditioners-Portable-Air-Conditioners/N-5yc1vZc4m4",
        "Dehumidifier": "https://www.homedepot.com/b/Heating-Venting-Cooling-Dehumidifiers/N-5yc1vZc4l8",
    },
    "walmart": {
        "Window": "https://www.walmart.com/browse/home-improvement/window-air-conditioners/1072864_133032_133026_587566",
        "Portable": "https://www.walmart.com/browse/home-improvement/portable-air-conditioners/1072864_133032_133026_587564",
        "Dehumidifier": "https://www.walmart.com/browse/home-improvement/dehumidifiers/1072864_133032_1231459_112918",
    },
}

# Date formats per layout (Spark datetime patterns).
DATE_FORMATS = {
    "amazon": "MMMM d, yyyy",
    "homedepot": "MMM d, yyyy",
    "walmart": "M/d/yyyy",
    "lowes": "yyyy-MM-dd",
}

DEFAULT_DAYS = 7
