"""Call-center tables derived from a TPC-H-like star schema.

Orders become calls, customers clients, suppliers agents; conversations and documents supply
transcripts. Every derived value is a hash of the row's key (``sampling.draw``) so that the same
table can be written down in any SQL engine with md5.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.functions import sampling as R
from callinsight.functions import scalars as X
from callinsight.operators.relations import with_speaker_names

YES_NO_ANSWERS = ["Yes", "YES, fully.", "No", "yes.", "no", None]
TONE_ANSWERS = [
    "Positive",
    "The tone was Negative.",
    "Neutral",
    "positive.",
    "Natural.",
    "Positive, not Negative",
    None,
]


# A derived table is a lazy plan: it is built once per session and folder and shared by queries.
reused = lru_cache(maxsize=64)


#: Tables from whose rows much is derived, and their key.
SPREAD = {"orders": "o_orderkey", "documents": "doc_id", "conversations": "conv_id"}
#: Rows of ``orders`` in a task at most, about.
ROWS = 250_000


@reused
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the schema.

    A file of one row group is one task's input. Rows that much is derived from are therefore dealt out by their key
    first, at every size; only the columns that a query needs are. Tasks are sized by Spark, by the bytes of these
    columns; many orders, whose keys alone are dealt but whose calls are many times wider, by their number."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name not in SPREAD:
        return rows
    if name == "orders" and (many := rows.count()) > ROWS * spark.sparkContext.defaultParallelism:
        return rows.repartition(-(-many // ROWS), SPREAD[name])
    return rows.repartition(SPREAD[name])


def agent_key(n: Column) -> Column:
    return F.concat(F.lit("A"), F.lpad(n.cast("string"), 10, "0"))


@reused
def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One client per customer; the nation stands in for the city."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("c_custkey").cast("string")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            key.alias("client_id"),
            F.lit("Customer").alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"),
            F.concat(
                F.lit("555-"),
                F.lpad(R.below("phone_a", F.col("c_custkey"), 1000).cast("string"), 3, "0"),
                F.lit("-"),
                F.lpad(R.below("phone_b", F.col("c_custkey"), 10000).cast("string"), 4, "0"),
            ).alias("phone_number"),
            F.concat(F.lit("client"), key, F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("client_city"),
            (F.lit(25) + F.col("n_nationkey")).cast("string").alias("latitude"),
            (-(F.lit(70) + F.col("n_nationkey"))).cast("string").alias("longitude"),
        )
    )


@reused
def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One agent per supplier."""
    return table(spark, sf_dir, "supplier").select(
        agent_key(F.col("s_suppkey")).alias("agent_id"),
        F.lit("Supplier").alias("first_name"),
        F.substring_index("s_name", "#", -1).alias("last_name"),
    )


@reused
def _calls_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the derived calls: ``k`` plus client, agent, date and time."""
    n_agents = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.alias("k"),
        k.cast("string").alias("call_id"),
        F.col("o_custkey").cast("string").alias("client_id"),
        agent_key(R.below("agent", k, n_agents)).alias("agent_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        X.clock(F.lit(32400) + R.below("time", k, 28801)).alias("time"),
    )


def _score(name: str, k: Column) -> Column:
    return F.when(R.below(f"null_{name}", k, 19) != 0, R.score(name, k))


def _raw_answers(k: Column) -> dict[str, Column]:
    """The answers as a model would word them."""
    return {
        "topic": R.pick("topic", k, S.TOPICS),
        "summary": F.concat(F.lit("Call "), k.cast("string")),
        **{c: R.pick(c, k, YES_NO_ANSWERS) for c in S.YES_NO_COLUMNS},
        **{c: R.pick(c, k, TONE_ANSWERS) for c in S.TONE_COLUMNS},
        **{c: _score(c, k) for c in S.SCORE_COLUMNS},
    }


@reused
def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw question answers, keyed by the anonymized text they were read from."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.concat(k.cast("string"), F.lit(".anon.txt")).alias("text_file"),
        *[c.alias(n) for n, c in _raw_answers(k).items()],
    )


@reused
def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fully analyzed calls in the call-table schema."""
    k = F.col("k")
    values = _raw_answers(k)
    for c in S.YES_NO_COLUMNS:
        values[c] = X.is_yes(values[c])
    for c in S.TONE_COLUMNS:
        values[c] = X.normalize_tone(values[c])
    values["status"] = F.lit("Analyzed")
    values["audio_file"] = F.concat("call_id", F.lit(".wav"))
    values["transcription_file"] = F.concat("call_id", F.lit(".txt"))
    values["anonymized_file"] = F.concat("call_id", F.lit(".anon.txt"))
    base = _calls_base(spark, sf_dir)
    return base.select(
        *[values[f.name].alias(f.name) if f.name in values else F.col(f.name) for f in S.CALL.fields]
    )


@reused
def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Call metadata as it leaves the generation step."""
    return _calls_base(spark, sf_dir).select(
        "call_id", X.text_file_name(F.col("call_id")).alias("text_file"), "client_id", "agent_id", "date", "time"
    )


def _kept(tag: str, k: Column) -> Column:
    """Whether the step named by ``tag`` succeeded for this call (about 1 in 23 fails)."""
    return R.below(tag, k, 23) != 0


@reused
def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio files per text: some texts have none, some have two."""
    k = F.col("o_orderkey")
    name = k.cast("string")
    takes = F.when(
        R.below("dup", k, 29) == 0,
        F.array(F.concat(name, F.lit(".wav")), F.concat(name, F.lit("_2.wav"))),
    ).otherwise(F.array(F.concat(name, F.lit(".wav"))))
    return (
        table(spark, sf_dir, "orders")
        .filter(_kept("fail_audio", k))
        .select(X.text_file_name(name).alias("text_file"), F.explode(takes).alias("audio_file"))
    )


@reused
def new_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls as inserted, before any processing: the analysis columns are NULL."""
    base = _calls_base(spark, sf_dir).withColumn("audio_file", F.concat("call_id", F.lit(".wav")))
    return base.select(
        *[
            F.col(f.name) if f.name in base.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in S.CALL.fields
        ]
    )


@reused
def step_outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """What each processing step reports back, failures left out."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    k = F.col("k")
    name = k.cast("string")
    return {
        "diarized": orders.filter(_kept("fail_diarize", k)).select(name.alias("call_id")),
        "transcribed": orders.filter(_kept("fail_transcribe", k)).select(
            F.concat(name, F.lit(".wav")).alias("audio_file"),
            F.concat(name, F.lit(".txt")).alias("transcription_file"),
        ),
        "anonymized": orders.filter(_kept("fail_anonymize", k)).select(
            F.concat(name, F.lit(".txt")).alias("original_file"),
            F.concat(name, F.lit(".anon.txt")).alias("anonymized_file"),
        ),
        "answered": orders.filter(_kept("fail_answer", k)).select(
            F.concat(name, F.lit(".anon.txt")).alias("text_file"),
            *[c.alias(n) for n, c in _raw_answers(k).items()],
        ),
    }


POLL_COUNT = 3


def _poll_answer(column: str, poll: int, k: Column) -> Column:
    tag = f"poll{poll}_{column}"
    return R.pick(tag, k, ["Yes", "No"]) if column in S.YES_NO_COLUMNS else R.score(tag, k).cast("string")


@reused
def answer_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model output per call as numbered lists: ``block_1`` and three polls of the second block.

    Some lists are one item short.
    """
    k = F.col("o_orderkey")
    raw = _raw_answers(k)

    def listed(tag: str, values: list[Column]) -> Column:
        lines = [F.concat(F.lit(f"{n}. "), v) for n, v in enumerate(values, start=1)]
        short = R.below(f"short_{tag}", k, 31) == 0
        return F.when(short, F.concat_ws("\n", *lines[:-1])).otherwise(F.concat_ws("\n", *lines))

    first = [F.coalesce(raw[c].cast("string"), F.lit("unknown")) for c in S.ANSWER_BLOCKS[0]]
    polls = {
        f"poll_{p}": listed(f"poll_{p}", [_poll_answer(c, p, k) for c in S.ANSWER_BLOCKS[1]])
        for p in range(1, POLL_COUNT + 1)
    }
    return table(spark, sf_dir, "orders").select(
        F.concat(k.cast("string"), F.lit(".anon.txt")).alias("text_file"),
        listed("block_1", first).alias("block_1"),
        *[text.alias(name) for name, text in polls.items()],
    )


@reused
def poll_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second question block answered several times: one row per call, question and poll.

    The answer is drawn on the row it belongs to: one small expression, not one per question and poll."""
    k = F.col("o_orderkey")
    yes_no, scores = F.array(F.lit("Yes"), F.lit("No")), F.array(*[F.lit(str(n)) for n in range(1, 6)])
    asked = [
        F.struct(F.lit(c).alias("question"), F.lit(p).alias("poll"), F.lit(f"poll{p}_{c}").alias("tag"), (yes_no if c in S.YES_NO_COLUMNS else scores).alias("choices"))
        for c in S.ANSWER_BLOCKS[1]
        for p in range(1, POLL_COUNT + 1)
    ]
    drawn = R.below(F.col("r.tag"), F.col("k"), F.size("r.choices")).cast("int")
    return (
        table(spark, sf_dir, "orders")
        .select(k.alias("k"), F.explode(F.array(*asked)).alias("r"))
        .select(
            F.concat(F.col("k").cast("string"), F.lit(".anon.txt")).alias("text_file"),
            "r.question",
            "r.poll",
            F.get("r.choices", drawn).alias("answer"),
        )
    )


@reused
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole transcript per document.

    Lines are spoken in turn by the agent and the client; every third line continues the turn
    before it. Nothing is grouped, so a transcript never has to be gathered from many rows.
    """
    lines = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.concat(
            F.when(i % 3 == 0, "Agent: ").when(i % 3 == 1, "Client: ").otherwise(""), line
        ),
    )
    call_id = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        call_id.alias("call_id"),
        X.text_file_name(call_id).alias("text_file"),
        F.array_join(lines, "\n").alias("text"),
    )


@reused
def named_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of calls that open by naming both speakers, with their names."""
    ids = _calls_base(spark, sf_dir).select("call_id", "client_id", "agent_id")
    named = with_speaker_names(ids, clients(spark, sf_dir), agents(spark, sf_dir))
    greeting = F.concat(
        F.lit("Agent: This is "), F.get("names", F.lit(3)), F.lit(", do I speak to "), F.get("names", F.lit(0)), F.lit("?\n")
    )
    return (
        transcripts(spark, sf_dir)
        .join(named, "call_id")
        .select("call_id", "text_file", F.concat(greeting, "text").alias("text"), "names")
    )


@reused
def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory of the recordings of :func:`audio`."""
    return audio(spark, sf_dir).select("audio_file", F.concat(F.lit("/recordings/"), "audio_file").alias("path"))


@reused
def call_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Agent ID, minutes): the length of each call, a continuous number; some are unknown."""
    n_agents = table(spark, sf_dir, "supplier").select(F.count("*")).scalar()
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        agent_key(R.below("agent", k, n_agents)).alias("Agent ID"),
        F.when(R.below("no_minutes", k, 31) != 0, F.col("o_totalprice") / 10_000).alias("minutes"),
    )


@reused
def deliveries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Calls, texts and recordings that do not fit each other: a third of the calls share one recording, some name none,
    some recordings have several texts or none, some texts no call."""
    k = F.col("o_orderkey")
    name = k.cast("string")
    recording = F.when(R.below("hot", k, 3) == 0, "hot.wav").when(R.below("unnamed", k, 17) != 0, F.concat(name, F.lit(".wav")))
    orders = table(spark, sf_dir, "orders")
    texts = orders.filter(R.below("no_text", k, 13) != 0).select(
        F.when(R.below("stray", k, 19) == 0, F.concat(F.lit("stray"), name, F.lit(".wav"))).otherwise(recording).alias("audio_file"),
        F.concat(name, F.lit(".txt")).alias("transcription_file"),
        F.when(R.below("empty", k, 23) != 0, F.concat(F.lit("Agent: call "), name)).alias("text"),
    )
    again = texts.filter(R.below("twice", F.col("transcription_file"), 29) == 0)
    later = texts.filter(R.below("later", F.col("transcription_file"), 31) == 0).withColumn("transcription_file", F.concat(F.lit("z"), "transcription_file"))
    return {
        "calls": orders.select(name.alias("call_id"), recording.alias("audio_file")),
        "texts": texts.unionByName(again).unionByName(later),
        "recordings": orders.filter(R.below("unrecorded", k, 37) != 0).select(F.concat(name, F.lit(".wav")).alias("audio_file")),
    }


@reused
def speaker_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text_file, name): the names of the speakers of :func:`named_transcripts`, as rows."""
    return named_transcripts(spark, sf_dir).select("text_file", F.explode("names").alias("name"))


@reused
def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded turns with the speaker names of a call; system messages are not speech."""
    speaker = F.when(F.col("role") == "user", "Client").when(F.col("role") == "assistant", "Agent")
    return (
        table(spark, sf_dir, "conversations")
        .filter(F.col("role") != "system")
        .select(
            F.col("conv_id").cast("string").alias("call_id"),
            F.col("turn").cast("int").alias("turn"),
            speaker.alias("speaker"),
            "text",
        )
    )


@reused
def defective(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three tables with broken rows mixed in, to exercise the integrity checks."""
    client, agent, call = clients(spark, sf_dir), agents(spark, sf_dir), new_calls(spark, sf_dir)
    k = F.col("call_id")
    dirty_call = call.withColumns(
        {
            "client_id": F.when(R.below("orphan", k, 41) == 0, F.concat(F.lit("X"), "client_id")).otherwise(
                F.col("client_id")
            ),
            "audio_file": F.when(R.below("no_audio", k, 43) != 0, F.col("audio_file")),
            "topic": F.when(R.below("long", k, 47) == 0, F.repeat(F.lit("topic "), 10)),
            "status": F.when(R.below("bad_status", k, 59) == 0, "Lost").when(R.below("status", k, 2) == 0, "Created"),
            "call_id": F.when(R.below("twice", k, 53) == 0, F.lit("same")).otherwise(k),
        }
    )
    dirty_client = client.withColumn(
        "client_city", F.when(R.below("no_city", F.col("client_id"), 37) != 0, F.col("client_city"))
    )
    return {"client": dirty_client, "agent": agent, "call": dirty_call}

