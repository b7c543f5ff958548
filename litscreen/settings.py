"""Fixed values. They decide the results, so they must keep exactly these values."""

# Folder names made from a query.
FORBIDDEN_NAME_CHARS = '[<>:"/\\\\|?*]'
NAME_LENGTH = 50
HASH_DIGITS = 8
BRACKETED_PARTS = r"\[.*?\]|\(.*?\)"

# Dates as they are stored and as they are searched for, and a search limited to a range.
STORED_DATE = "yyyy-MM-dd"
SEARCHED_DATE = "yyyy/MM/dd"
DATED_SEARCH = "%s AND (%s[PubDate] : %s[PubDate])"

# Selection of articles.
ARTICLES_PER_QUERY = 50
RUN_INTERVAL_DAYS = 7

# Columns of the data sets.
ABSTRACT_COLUMNS = ("Abstract", "ID")
TEXT_COLUMN = "text"
ID_COLUMN = "ID"
SCORE_COLUMNS = ("AwT_score", "SoE_score")
RANDOMIZED_COLUMNS = ("randomized_AwT_score", "randomized_SoE_score")
EVALUATED_COLUMNS = ("predicted_AwT_score", "predicted_SoE_score")
PREDICTED_COLUMNS = ("Predicted_AwT_score", "Predicted_SoE_score")

# Thresholds of the final filter, in the order of PREDICTED_COLUMNS.
KEEP_THRESHOLDS = (0.7, 0.4)

# Training and scoring.
MAX_DEVIATION = 0.05
TEST_SHARE = 0.2
SPLIT_SEED = 42
ENSEMBLE_SIZE = 4
TRAINING_BATCH = 6
EPOCHS = 16
STEPS_PER_EPOCH = 8
LEARNING_RATE = 0.05
SCORING_BATCH = 15
MAX_TOKENS = 512

# Ids of the special tokens.
PAD_ID, UNKNOWN_ID, START_ID, END_ID = 0, 1, 2, 3

# Layout of tables: hash buckets of a new table (or of each of its folders).
TABLE_BUCKETS = 8
INDEX_BUCKETS = 64
