"""Calls, texts and recordings brought together by recording, so that every input is accounted for.

All three meet as narrow rows (file names, ids, digests) in one aggregate per recording, which folds a busy recording
inside each task. Outcomes go back to calls and texts by a join whose small side is clustered by a hash of the key:
an ordinary exchange sits below the join, and Spark splits the rows of a hot recording. Rows that name no
recording (NULL) take part in neither, so they cannot meet in one task. Texts themselves are moved once, when the
last text of each recording is picked. Counts and lists of errors need no such join: counts follow from the
aggregate alone, and errors from the folded texts, which meet the last ones by all that tells texts apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Outcomes; USED and READY are success, all others are errors of the input.
USED, READY = "used", "has a text"
UNNAMED = "no recording named"
REPEATED = "a later text of the recording is used"
STRAY = "no call has this recording"
EMPTY = "no text"
SILENT = "no transcript"
LOST = "no such recording"


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("\x00")))


def _folded(texts: DataFrame) -> DataFrame:
    """(audio_file, transcription_file, digest, empty, copies) of the texts that name a recording, equal ones once."""
    told = [_digest(F.col("text")).alias("digest"), F.col("text").isNull().alias("empty")]
    return texts.filter("audio_file is not null").groupBy("audio_file", "transcription_file", *told).agg(F.count("*").alias("copies"))


def by_recording(calls: DataFrame, texts: DataFrame, recordings: DataFrame | None = None) -> DataFrame:
    """(audio_file, call_id, calls, texts, last, recorded): one row per recording that any of the inputs names.

    ``calls``: (call_id, audio_file), ``texts``: (audio_file, transcription_file, text), ``recordings``: (audio_file).
    ``call_id`` is the lowest of the recording's calls; ``last`` is (transcription_file, digest, empty, copies) of the
    last text by file name (of equal names, by digest), ``copies`` counting rows that are equal in all of it.
    """
    none = {"call_id": "string", "last": "struct<transcription_file: string, digest: string, empty: boolean, copies: bigint>"}

    def rows(df: DataFrame, **have: Column) -> DataFrame:
        counted = {c: have.get(c, F.lit(0)).cast("bigint") for c in ("calls", "texts", "recorded")}
        other = {c: have.get(c, F.lit(None)).cast(t) for c, t in none.items()}
        return df.filter("audio_file is not null").select("audio_file", *[v.alias(c) for c, v in {**counted, **other}.items()])

    narrow = rows(calls, calls=F.lit(1), call_id=F.col("call_id")).unionByName(
        rows(_folded(texts), texts=F.col("copies"), last=F.struct("transcription_file", "digest", "empty", "copies"))
    )
    if recordings is not None:
        narrow = narrow.unionByName(rows(recordings, recorded=F.lit(1)))
    return narrow.groupBy(F.xxhash64("audio_file").alias("_spread"), "audio_file").agg(
        F.min("call_id").alias("call_id"),
        F.sum("calls").alias("calls"),
        F.sum("texts").alias("texts"),
        F.max("last").alias("last"),
        F.sum("recorded").alias("recorded"),
    ).drop("_spread")


def _meet(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with what was found of their recording; rows without one are set aside first."""
    named = rows.filter("audio_file is not null").join(found, "audio_file", "left")
    return named.unionByName(rows.filter("audio_file is null"), allowMissingColumns=True)


def call_outcomes(calls: DataFrame, found: DataFrame, inventory: bool = False) -> DataFrame:
    """The calls with ``outcome``. ``found``: :func:`by_recording`; ``inventory``: it was given the recordings."""
    outcome = F.when(F.col("audio_file").isNull(), UNNAMED)
    if inventory:
        outcome = outcome.when(F.coalesce("_recorded", F.lit(0)) == 0, LOST)
    outcome = outcome.when(F.coalesce("_texts", F.lit(0)) == 0, SILENT).otherwise(READY)
    narrow = found.select("audio_file", F.col("texts").alias("_texts"), F.col("recorded").alias("_recorded"))
    return _meet(calls, narrow).withColumn("outcome", outcome).select(*calls.columns, "outcome")


def text_outcomes(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The texts (audio_file, transcription_file, text) with ``call_id``, the recording's lowest, and ``outcome``.

    Of rows that are equal in all three columns each has the outcome of the text, see :func:`last_texts`.
    """
    last = F.col("_last")
    is_last = F.col("transcription_file").eqNullSafe(last["transcription_file"]) & (_digest(F.col("text")) == last["digest"]) & (F.col("text").isNull() == last["empty"])
    outcome = (
        F.when(F.col("audio_file").isNull(), UNNAMED)
        .when(~is_last, REPEATED)
        .when(F.col("_call").isNull(), STRAY)
        .when(F.col("text").isNull(), EMPTY)
        .otherwise(USED)
    )
    narrow = found.select("audio_file", F.col("call_id").alias("_call"), F.col("last").alias("_last"))
    marked = _meet(texts.select("audio_file", "transcription_file", "text"), narrow).withColumn("outcome", outcome)
    return marked.select("audio_file", "transcription_file", "text", F.col("_call").alias("call_id"), last["copies"].alias("copies"), "outcome")


def last_texts(outcomes: DataFrame) -> DataFrame:
    """(call_id, audio_file, transcription_file, text): the last text of each recording that has calls, once.

    Includes recordings whose last text is NULL. Only texts with equal copies are folded.
    """
    last = outcomes.filter(F.col("outcome").isin(USED, EMPTY)).select("call_id", "audio_file", "transcription_file", "text", "copies")
    once = last.filter("copies = 1").unionByName(last.filter("copies > 1").dropDuplicates(["audio_file"]))
    return once.drop("copies")


def errors_of_texts(outcomes: DataFrame) -> DataFrame:
    """(audio_file, transcription_file, error): every text row that goes no further, spare copies of a used one too."""
    lost = outcomes.filter(~F.col("outcome").isin(USED)).select("audio_file", "transcription_file", "copies", F.col("outcome").alias("error"))
    # Of an unread last text the first copy has its own error and the others are repetitions.
    first = outcomes.filter(F.col("outcome").isin(USED, EMPTY) & (F.col("copies") > 1))
    spare = first.groupBy("audio_file", "transcription_file", "copies").agg(F.min("outcome").alias("outcome"))
    again = spare.select("audio_file", "transcription_file", F.explode(F.sequence(F.lit(2), F.col("copies"))).alias("_n")).select(
        "audio_file", "transcription_file", F.lit(REPEATED).alias("error")
    )
    single = lost.filter((F.col("error") != EMPTY) | (F.col("copies") == 1)).select("audio_file", "transcription_file", "error")
    empty = spare.filter(F.col("outcome") == EMPTY).select("audio_file", "transcription_file", F.lit(EMPTY).alias("error"))
    return single.unionByName(empty).unionByName(again)


def text_errors(texts: DataFrame, found: DataFrame) -> DataFrame:
    """:func:`errors_of_texts` of the outcomes of ``texts``, which are not joined by recording for it.

    Folded texts meet the last ones by recording, file name and digest: such keys are as many as the folded texts, so a
    recording with many texts is spread over all tasks, and no text is moved."""
    told = ["audio_file", "transcription_file", "digest", "empty"]
    last = found.filter("last is not null").select("audio_file", "call_id", "last.transcription_file", "last.digest", "last.empty", F.lit(True).alias("_last"))
    one, two = _folded(texts).alias("one"), last.alias("two")
    same = [F.col(f"one.{c}").eqNullSafe(F.col(f"two.{c}")) for c in told]
    met = one.join(two, same, "left").select("one.*", "call_id", "_last")
    stray = F.col("_last") & F.col("call_id").isNull()
    fate = F.when(stray, STRAY).when(F.col("_last") & F.col("empty"), EMPTY).when(F.col("_last"), USED).otherwise(REPEATED)
    # Of a used or empty last text the first copy has that outcome and the others are repetitions.
    each = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("copies")), lambda n: F.when((n == 1) | (fate == STRAY), fate).otherwise(REPEATED))
    named = met.select("audio_file", "transcription_file", F.explode(each).alias("error")).filter(F.col("error") != USED)
    return named.unionByName(texts.filter("audio_file is null").select("audio_file", "transcription_file", F.lit(UNNAMED).alias("error")))


def accounted(calls: DataFrame, texts: DataFrame, recordings: DataFrame | None = None) -> DataFrame:
    """(input, outcome, rows): how the inputs of each kind fared; their rows add up to the inputs.

    A row per outcome that occurs. The counts follow from what :func:`by_recording` finds, by the rules of
    :func:`call_outcomes` and :func:`text_outcomes`; calls and texts are not joined to it.
    """
    found = by_recording(calls, texts, recordings)

    def count(kind: str, outcome: Column | str, n: Column) -> Column:
        return F.struct(F.lit(kind).alias("input"), (F.lit(outcome) if isinstance(outcome, str) else outcome).alias("outcome"), n.cast("bigint").alias("n"))

    of_calls = F.when(F.col("texts") == 0, SILENT).otherwise(READY)
    if recordings is not None:
        of_calls = F.when(F.col("recorded") == 0, LOST).otherwise(of_calls)
    # Equal copies of a last text count once as such and otherwise as repetitions; of a stray one all are stray.
    stray = F.col("call_id").isNull()
    first = F.when(F.col("texts") == 0, 0).when(stray, F.col("last.copies")).otherwise(1)
    counts = [
        count("call", of_calls, F.col("calls")),
        count("text", F.when(stray, STRAY).when(F.col("last.empty"), EMPTY).otherwise(USED), first),
        count("text", REPEATED, F.col("texts") - first),
        count("recording", F.when(F.col("calls") > 0, USED).otherwise(STRAY), F.col("recorded")),
    ]
    rows = found.select(F.explode(F.array(*counts)).alias("r")).select("r.*")
    for kind, inputs in (("call", calls), ("text", texts), ("recording", recordings)):
        if inputs is not None:
            rows = rows.unionByName(inputs.filter("audio_file is null").select(count(kind, UNNAMED, F.lit(1)).alias("r")).select("r.*"))
    return rows.groupBy("input", "outcome").agg(F.sum("n").alias("rows")).filter("rows > 0")
