"""Table schemas, vocabularies and display names.

Every reader and writer in the package uses these explicit schemas; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: status names, topics, tones, labels, display names, targets ---------------

CALL_STATUSES = [
    "Created",
    "Audio processed",
    "Speech diarized",
    "Transcribed",
    "Translated",
    "Anonymized",
    "Analyzed",
]

TOPICS = [
    "slow internet speed",
    "billing discrepancies",
    "account login problems",
    "setting up a new device",
    "phishing or malware concerns",
    "scheduled maintenance notifications",
    "service upgrades",
    "negotiating pricing",
    "canceling service",
    "customer service feedback",
]

TONES = ["Positive", "Neutral", "Negative"]

CONCERN_LABELS = ["Concerns Not Addressed", "Concerns Addressed"]

UPSALE_LABELS = ["Failed Upsales", "No Upsale Attempted", "Successful Upsales"]
UPSALE_ORDER = ["Successful Upsales", "No Upsale Attempted", "Failed Upsales"]

DISPLAY_NAMES = {
    "active_listening": "Active Listening",
    "agent_id": "Agent ID",
    "agent_tone": "Agent Tone",
    "date": "Call Date",
    "client_id": "Caller ID",
    "client_tone": "Client Tone",
    "concern_addressed": "Concern Addressed",
    "customization": "Customization",
    "effective_communication": "Effective Communication",
    "empathy": "Empathy",
    "kindness": "Kindness",
    "professionalism": "Professionalism",
    "summary": "Summary",
    "time": "Time",
    "topic": "Topic",
    "upsale_attempted": "Upsale Attempted",
    "upsale_success": "Upsale Success",
    "client_city": "Caller City",
    "anonymized_file": "text_file",
}

QUALITY_METRICS = [
    "Empathy",
    "Professionalism",
    "Kindness",
    "Effective Communication",
    "Active Listening",
]

UPSALE_TARGET = 0.25
CONCERN_TARGET = 0.50

WORDS_PER_MINUTE = 240

MIN_BUBBLE = 10.0
MAX_BUBBLE = 50.0

# --- Column groups ----------------------------------------------------------------------------

SCORE_COLUMNS = [
    "empathy",
    "professionalism",
    "kindness",
    "effective_communication",
    "active_listening",
    "customization",
]
YES_NO_COLUMNS = ["concern_addressed", "upsale_attempted", "upsale_success"]
TONE_COLUMNS = ["client_tone", "agent_tone"]

# The two question blocks put to the model; answers come back numbered per block.
ANSWER_BLOCKS = [
    ["topic", "summary", "concern_addressed", "client_tone", "agent_tone"],
    ["upsale_attempted", "upsale_success", *SCORE_COLUMNS],
]
ANSWER_COLUMNS = [c for block in ANSWER_BLOCKS for c in block]


# --- Stored tables ----------------------------------------------------------------------------


def _text(name: str, length: int, required: bool = True) -> T.StructField:
    """A string column; the length limit travels as metadata and is checked by ``integrity``."""
    return T.StructField(name, T.StringType(), True, {"max_length": length, "required": required})


def _required(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True, {"required": True})


CLIENT = T.StructType(
    [
        _text("client_id", 32),
        _text("first_name", 30),
        _text("last_name", 30),
        _text("phone_number", 20),
        _text("email", 50),
        _text("client_city", 30),
        _text("latitude", 20),
        _text("longitude", 20),
    ]
)

AGENT = T.StructType([_text("agent_id", 32), _text("first_name", 30), _text("last_name", 30)])

# ``time`` is kept as an HH:mm:ss string: parquet has no portable time-of-day type in Spark.
CALL = T.StructType(
    [
        _text("call_id", 32),
        _text("client_id", 32),
        _text("agent_id", 32),
        _required("date", T.DateType()),
        _required("time", T.StringType()),
        T.StructField("status", T.StringType()),
        _text("audio_file", 500),
        _text("transcription_file", 500, required=False),
        _text("anonymized_file", 500, required=False),
        _text("topic", 50, required=False),
        _text("summary", 1000, required=False),
        T.StructField("concern_addressed", T.BooleanType()),
        _text("client_tone", 20, required=False),
        _text("agent_tone", 20, required=False),
        T.StructField("upsale_attempted", T.BooleanType()),
        T.StructField("upsale_success", T.BooleanType()),
        *[T.StructField(c, T.IntegerType()) for c in SCORE_COLUMNS],
    ]
)

TABLES = {"client": CLIENT, "agent": AGENT, "call": CALL}
PRIMARY_KEYS = {"client": "client_id", "agent": "agent_id", "call": "call_id"}
FOREIGN_KEYS = [("call", "client_id", "client"), ("call", "agent_id", "agent")]

# --- Datasets passed between steps ------------------------------------------------------------

METADATA = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("text_file", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("time", T.StringType()),
    ]
)

AUDIO = T.StructType(
    [T.StructField("text_file", T.StringType()), T.StructField("audio_file", T.StringType())]
)

CALLS_BATCH = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("time", T.StringType()),
        T.StructField("audio_file", T.StringType()),
    ]
)

GROUND_TRUTHS = T.StructType(
    [
        T.StructField("call_id", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("concern_addressed", T.BooleanType()),
        T.StructField("agent_tries_upsale", T.BooleanType()),
        T.StructField("agent_succeeds_upsale", T.BooleanType()),
        T.StructField("client_tone", T.StringType()),
        T.StructField("agent_tone", T.StringType()),
        T.StructField("agent_id", T.StringType()),
        T.StructField("client_id", T.StringType()),
        *[T.StructField(c, T.IntegerType()) for c in SCORE_COLUMNS],
    ]
)

DATASETS = {
    "metadata": METADATA,
    "dataframe": AUDIO,
    "calls_batch": CALLS_BATCH,
    "ground_truths": GROUND_TRUTHS,
}

# The dashboard frame: call columns under display names plus the caller's place.
DASHBOARD = T.StructType(
    [T.StructField(DISPLAY_NAMES.get(f.name, f.name), f.dataType) for f in CALL.fields]
    + [
        T.StructField("Caller City", T.StringType()),
        T.StructField("latitude", T.StringType()),
        T.StructField("longitude", T.StringType()),
    ]
)
