"""Values whose content is part of the result contract."""

# --- fixed values -----------------------------------------------------------------------------
# Source names; they are hashed into every signal_id.
STORIES = "hackernews"
REPOS = "github"
PAPERS = "arxiv"
QUESTIONS = "stackoverflow"

# Prefix used when a story carries no url of its own.
STORY_URL_PREFIX = "https://news.ycombinator.com/item?id="

# Words never counted as title terms.
STOP_WORDS = [
    "that", "this", "with", "from", "what", "have", "your", "will",
    "about", "they", "been", "more", "when", "than", "just", "like",
    "does", "into", "some", "only", "other", "also", "there", "which",
]

# Enrichment taxonomy; anything else becomes "Other".
CATEGORIES = [
    "AI/ML", "Data Engineering", "Cloud", "DevOps", "Web", "Systems", "Security", "Other",
]
SENTIMENTS = ["positive", "neutral", "negative"]
DEFAULT_CATEGORY = "Other"
DEFAULT_SENTIMENT = "neutral"

# Record written when a response cannot be used.
ERROR_CATEGORY = "error"
ERROR_SUMMARY = "Enrichment failed — retry later"

# Prompt layout.
PROMPT_FORMAT = (
    "Analyse this tech signal:\nSource: %s\nTitle: %s\nTags: %s\nBody: %s\n\n"
    'Respond with JSON: {"category": "...", "summary": "...", '
    '"sentiment": "...", "is_emerging": true/false}'
)

# Limits and thresholds.
TRENDING_PER_GROUP = 50
ACCELERATION = 0.2
MAX_AGE_HOURS = 48
MAX_NULL_SHARE = 0.10
MAX_DUPLICATE_SHARE = 0.01
ENRICH_BATCH_SIZE = 20
# ----------------------------------------------------------------------------------------------
