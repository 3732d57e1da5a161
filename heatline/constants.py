"""Numbers, patterns, formats and word lists that results depend on."""

# Text cleaning and message formats.
CLEAN_PATTERN = r"([^\s\w_]|_)+"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
LEGACY_ENCODING = "ISO-8859-1"
SCORE_JSON_PATH = "$.attributeScores.TOXICITY.summaryScore.value"

# ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Collection and batch settings.
FETCH_CAP = 100
BATCH_SECONDS = 120
SYNTHETIC_AXIS_START = "2018-04-13 10:31:30"

# Forecasting and evaluation.
FORECAST_SHARE = 0.25
SEASON = 12
SCORE_SCALE = 100.0
TRAIN_SHARE = 0.75
SPLIT_SEED = 12345
FIT_BAND = (20.0, 50.0)

# Outlier test (local correlation integral).
LOCI_ALPHA = 0.5
LOCI_K = 3
LOCI_MIN_NEIGHBOURS = 20

# State models.
ACCELERATION_DT = 1 / 60
ACCELERATION_Q = ((0.05, 0.05, 0.0), (0.05, 0.05, 0.0), (0.0, 0.0, 0.0))
ACCELERATION_R = 0.5
VELOCITY_START = 1000.0
VELOCITY_R = 5.0
VELOCITY_NOISE = 0.1

# Text model.
HASH_FEATURES = 1000
TREE_DEPTH = 10
BOOSTING_ROUNDS = 50
LEARNING_RATE = 0.1
GRID_FEATURES = (10, 100, 1000)
GRID_DEPTHS = (5, 8, 10, 20)
GRID_ROUNDS = (10, 20, 50, 100)
FOLDS = 5

# English stop words (the list Spark ML ships as "english").
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)
