"""Names, patterns and texts that results have to agree on."""

# --- Fixed values: communities, in listing order -----------------------------
COMMUNITIES = [
    "dataengineering",
    "machinelearning",
    "datascience",
    "claudeai",
    "singularity",
    "localllama",
    "openai",
    "stablediffusion",
]

# --- Fixed values: display names of communities -------------------------------
COMMUNITY_DISPLAY_NAMES = {
    "claudeai": "ClaudeAI",
    "dataengineering": "Data Engineering",
    "datascience": "Data Science",
    "localllama": "LocalLLaMA",
    "machinelearning": "Machine Learning",
    "openai": "OpenAI",
    "singularity": "Singularity",
    "stablediffusion": "Stable Diffusion",
}
COMMUNITY_DISPLAY_SUFFIX = " Subreddit"

# --- Fixed values: ingest limits -----------------------------------------------
POSTS_PER_COMMUNITY = 20
COMMENTS_PER_POST = 10
DELETED = "[deleted]"

# --- Fixed values: masking -----------------------------------------------------
MASK = "***"
EXTRA_MASKED_WORDS = ["wtf", "stfu", "bullcrap", "dhead", "douche"]
NEVER_MASKED_WORDS = [
    "frank", "floor", "fridge", "future", "first", "flip", "fact", "from",
    "for", "food", "free", "front", "frame", "fresh", "friday", "friend",
]
OBFUSCATION_PATTERNS = [
    r"\b[f]+[\W_]*[u]+[\W_]*[c]+[\W_]*[k]+(?:ing|er|ed)?\b",
    r"what\s+the\s+[f]+[\W_]*(?:[u]+[\W_]*)?[c]+[\W_]*[k]+\b",
    r"\bthe\s+[f]+[\W_]*(?:[u]+[\W_]*)?[c]+[\W_]*[k]+\b",
    r"\bbull\s*cr[a@4]p\b",
]
OBFUSCATION_FIRST_LETTERS = ["f", "w", "t", "b"]

# --- Fixed values: quality bounds -----------------------------------------------
MIN_BODY_CHARS = 2
MAX_BODY_CHARS = 10000
PROCESSED_BY = "dbt"

# --- Fixed values: model stages ---------------------------------------------------
CLASSIFIER_MAX_CHARS = 500
SHORT_TEXT_MAX_WORDS = 59
SUMMARY_MAX_TOKENS = 60
SUMMARY_MIN_TOKENS = 15
SENTIMENTS = ["Positive", "Negative", "Neutral"]
EMOTION_SENTIMENT = {
    "joy": "Positive",
    "love": "Positive",
    "admiration": "Positive",
    "approval": "Positive",
    "caring": "Positive",
    "excitement": "Positive",
    "gratitude": "Positive",
    "pride": "Positive",
    "optimism": "Positive",
    "relief": "Positive",
    "anger": "Negative",
    "annoyance": "Negative",
    "disappointment": "Negative",
    "disapproval": "Negative",
    "disgust": "Negative",
    "embarrassment": "Negative",
    "fear": "Negative",
    "grief": "Negative",
    "nervousness": "Negative",
    "remorse": "Negative",
    "sadness": "Negative",
    "confusion": "Neutral",
    "curiosity": "Neutral",
    "realization": "Neutral",
    "surprise": "Neutral",
    "neutral": "Neutral",
}
# The classifier's label set, alphabetical with "neutral" last.
EMOTIONS = [
    "admiration", "amusement", "anger", "annoyance", "approval", "caring",
    "confusion", "curiosity", "desire", "disappointment", "disapproval",
    "disgust", "embarrassment", "excitement", "fear", "gratitude", "grief",
    "joy", "love", "nervousness", "optimism", "pride", "realization",
    "relief", "remorse", "sadness", "surprise", "neutral",
]

# --- Fixed values: report texts ---------------------------------------------------
BLOCK_PREFIX = "~~~"
BLOCK_FIELDS = [
    "post_id", "subreddit", "post_score", "post_url", "comment_id",
    "summary_date", "post_content", "comment_body", "comment_summary",
    "sentiment_score", "sentiment_label",
]
HARMFUL_MESSAGE = "Analysis Skipped: Content contains harmful material."
RANKING_HEADING = "# Overall Ranking and Top Discussions"
DETAIL_HEADING = "# Detailed Analysis by Thread"
VIEWS_PER_THREAD = 3
REPORT_FILE_PREFIX = "llm_"

# --- Fixed values: run-metric bounds -------------------------------------------------
DURATION_BOUNDS_SECONDS = [10, 30, 60, 120, 300, 600, 1800]
ERROR_RATE_WINDOW_SECONDS = 300
