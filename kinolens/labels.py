"""Label spaces, word lists and parameter tables.

Everything in this module is a fixed value: results are only comparable when
these lists and their order are kept.
"""

# --- fixed values: label order of the full and the shortened target vector ---
LABELS_18 = [
    "animation", "action", "comedy", "crime", "drama", "family", "fantasy",
    "history", "horror", "music", "musical", "mystery", "romance", "sci-fi",
    "sport", "thriller", "war", "western",
]
KEPT_POSITIONS = [0, 1, 2, 4, 5, 6, 8, 10, 11, 12, 13, 15, 16, 17]
LABELS_14 = [LABELS_18[i] for i in KEPT_POSITIONS]

# --- fixed values: boosted-tree parameters per label, in LABELS_14 order ---
TREES_PER_LABEL = [700, 700, 700, 700, 700, 500, 700, 700, 500, 500, 700, 700, 700, 700]
DEPTH_PER_LABEL = [5, 4, 5, 6, 4, 5, 3, 4, 7, 5, 5, 5, 4, 3]

# --- fixed values: genres that never become labels ---
UNWANTED_GENRES = ["adventure", "biography", "documentary", "drama", "film-noir"]

# --- fixed values: probability cut-offs used by the reports ---
CUTOFFS = [0.1, 0.2, 0.25, 0.3, 0.4]
POLARITY_CUTOFFS = [0.01, 0.09, 0.1, 0.11]

# --- fixed values: listing offsets (titles) and review offsets per film ---
LISTING_OFFSETS = [0, 51, 101, 151, 201, 251]
REVIEW_OFFSETS = [0, 10, 20, 30]

# --- fixed values: sizes of vocabularies ---
MAX_FEATURES = 6000
COMMON_TOP = 5000
FEATURE_TOP = 37
CLOUD_WORDS = 75

# --- fixed values: punctuation tokens treated as stop words ---
STOP_PUNCTUATION = [
    ".", ",", "!", "?", ":", ";", "...", "(", ")", "/", '"', ".)", "),", '")', ')"',
]

# --- fixed values: the English list of pyspark.ml.feature.StopWordsRemover ---
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more
most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()

# --- fixed values: boilerplate of review pages that is not review text ---
USEFUL_NOTICE = "Was the above review useful to you?"
SPOILER_NOTICE = "*** This review may contain spoilers ***"
ADD_REVIEW_NOTICE = "Add another review"
