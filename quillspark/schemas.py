"""Explicit schemas of the inputs and the fixed names of the outputs."""

from pyspark.sql import types as T

LABELS = ["HS", "TR", "AG"]
CLASSES = ["HS", "HS+AG", "HS+TR", "HS+TR+AG", "NotHS"]

# The ten emotion names in feature order and in model order.
EMOTIONS = [
    "negative", "positive", "anger", "anticipation", "disgust",
    "fear", "joy", "sadness", "surprise", "trust",
]
EXT_EMOTIONS = [
    "fear", "anger", "anticipation", "trust", "surprise",
    "positive", "negative", "sadness", "disgust", "joy",
]

SYMBOLS = ["!", "?", "$", "*"]

LANGUAGES = {"english": "en", "spanish": "es"}

LABELLED_TEXT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("HS", T.IntegerType()),
        T.StructField("TR", T.IntegerType()),
        T.StructField("AG", T.IntegerType()),
    ]
)
GOLD = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("HS", T.IntegerType()),
        T.StructField("TR", T.IntegerType()),
        T.StructField("AG", T.IntegerType()),
    ]
)
PREDICTION_A = T.StructType(
    [T.StructField("ID", T.StringType()), T.StructField("HS", T.IntegerType())]
)
PREDICTION_B = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("HS", T.IntegerType()),
        T.StructField("TR", T.IntegerType()),
        T.StructField("AG", T.IntegerType()),
    ]
)
SLANG = T.StructType([T.StructField("term", T.StringType()), T.StructField("score", T.IntegerType())])
EMOTION_ES = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("emotion", T.StringType()),
        T.StructField("en_word", T.StringType()),
    ]
)


def count_column(symbol: str) -> str:
    return f"{symbol}_count"


def normalized_column(name: str) -> str:
    return f"{name}_normalized"


def default_features(language: str = "english") -> list[str]:
    """The 26 scalar features used when none are named (Spanish adds the ``_esp`` shares)."""
    symbols = [normalized_column(count_column(s)) for s in SYMBOLS]
    extended = [f"{e}_ext" for e in EMOTIONS]
    score = "slangscore" if language == "english" else "sent_score"
    spanish = [f"{e}_esp" for e in EMOTIONS] if language == "spanish" else []
    return ["percent_capitals", *symbols, *EMOTIONS, *spanish, *extended, score]
