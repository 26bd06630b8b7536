"""Vocabularies, names, formats and thresholds of the data format.

They have to be exactly these for results to be right.
"""

# Instruction variants.
STYLES = ["persona", "negation", "background", "generic"]
LENGTHS = ["short", "medium", "long", "very long"]

# Passage labels and the ways a negative passage may fail its instruction.
POSITIVE = "positive"
NEGATIVE = "negative"
FAILURE_MODES = [
    "omission",
    "different_interpretation",
    "mentions_excluded_element",
    "partial_answer",
    "outdated_info",
    "unsupported_inference",
]

# Keys that may hold a passage's score, first usable one wins.
SCORE_KEYS = ["confidence", "score", "confidence_score", "probability", "relevance"]

# Column names of the package text table, by position.
PACKAGE_COLUMNS = ["ID", "Query", "OgPositive", "Instruction", "Response"]

# Q&A columns that carry no text for the prompts.
QA_METADATA = ["Keywords", "ID", "SE_penalized", "Cluster_labels"]

# Text shown to the relevance scorer.
SCORER_TEMPLATE = "Is the passage about {query}?: {text}"

# Error code a completion may return instead of passages.
ERROR_TOO_FEW_NEGATIVES = "COULD_NOT_GENERATE_N_NEGATIVES"

# Package contract.
NEGATIVES_COUNT = 5
POSITIVE_WORDS = (80, 150)
NEGATIVE_WORDS = (60, 140)
MIN_FAILURE_MODES = 4

# Score thresholds and list sizes.
POSITIVE_THRESHOLD = 0.7
NEGATIVE_THRESHOLD = 0.3
BOTTOM_NEGATIVES = 3
HISTOGRAM_BINS = 50
PREVIEW_ROWS = 3
PREVIEW_CHARS = 100

# Texts that a CSV field may use for "missing" (the pandas reader's default set).
CSV_MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
