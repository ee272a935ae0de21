"""Column layouts and fixed settings shared by all jobs."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _layout(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


# Column names, topics, triggers and model settings that callers rely on.
RATING_COLUMNS = ["timestamp", "rating", "user_id", "parent_asin"]
METADATA_COLUMNS = ["parent_asin", "store"]
REQUESTS_TOPIC = "recommendations"
ACTIONS_TOPIC = "users.actions"
RECOMMEND_TRIGGER = "30 seconds"
RETRAIN_TRIGGER = "120 seconds"
POSITIVE_THRESHOLD = 4.5
TOP_K = 5
VALIDATION_FRACTION = 0.2
SEED = 42
EMBEDDING_SIZE = 8
HIDDEN_SIZES = (32, 24, 10)
TRAIN_EPOCHS = 10
STREAM_EPOCHS = 3
BATCH_SIZE = 16
LEARNING_RATE = 1e-4
MOMENTUM = 0.9
DROPOUT = 0.1
USER_MAP, ITEM_MAP, STORE_MAP = "user_id_map", "parent_id_map", "store_id_map"

RATINGS = _layout(
    ("timestamp", LongType()),
    ("rating", DoubleType()),
    ("user_id", StringType()),
    ("parent_asin", StringType()),
)
METADATA = _layout(("parent_asin", StringType()), ("store", StringType()))
ACTION_MESSAGE = _layout(
    ("timestamp", IntegerType()),
    ("rating", FloatType()),
    ("user_id", StringType()),
    ("parent_asin", StringType()),
)
REQUEST_MESSAGE = _layout(("user_id", StringType()))
DATASET = _layout(
    ("parent_asin", IntegerType()),
    ("timestamp", LongType()),
    ("rating", DoubleType()),
    ("user_id", IntegerType()),
    ("store", IntegerType()),
)
FEATURE_MAP = _layout(("feature", StringType()), ("value", StringType()), ("idx", IntegerType()))
RECOMMENDATION_LISTS = _layout(
    ("user_id", StringType()), ("top_k_asins", ArrayType(StringType()))
)
KEYED_ROWS = _layout(
    ("user_id", StringType()), ("recommendations", StringType()), ("run", LongType()), ("batch_id", LongType())
)
RUNS = _layout(("name", StringType()), ("run", LongType()))
COMPACTIONS = _layout(
    ("number", LongType()),
    ("folder", StringType()),
    ("covered", ArrayType(_layout(("run", LongType()), ("batch_id", LongType())))),
)
MODEL_VERSIONS = _layout(
    ("model", StringType()),
    ("timestamp", TimestampType()),
    ("binary", BinaryType()),
    ("version", IntegerType()),
    ("maps_version", StringType()),
    ("embeddings_path", StringType()),
    ("source", StringType()),
)
HISTORY = _layout(
    ("run_id", StringType()),
    ("epoch", IntegerType()),
    ("train_loss", DoubleType()),
    ("train_roc_auc", DoubleType()),
    ("test_loss", DoubleType()),
    ("test_roc_auc", DoubleType()),
)
