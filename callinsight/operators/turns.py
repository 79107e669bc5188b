"""Speaker turns of a transcript and talk statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.functions import scalars as X

# Line labels and the speaker each one stands for.
SPEAKERS = {"Agent": "Agent", "Client": "Client", "Customer": "Client"}

_LABEL = "|".join(SPEAKERS)
_WHITE = " \t\n\r\x0b\x0c"


def split_turns(transcripts: DataFrame) -> DataFrame:
    """One row per turn: (call_id, turn, speaker, text).

    A turn runs from its label to the next labelled line, so unlabelled lines continue the turn
    before them. Text ahead of the first label is kept without a speaker. Each transcript is
    split within its own row: there is no shuffle.
    """
    parts = F.filter(
        F.split("text", rf"(?md)(?=^(?:{_LABEL}):)", -1), lambda part: F.btrim(part, F.lit(_WHITE)) != ""
    )
    label = F.regexp_extract("_part", rf"^({_LABEL}):", 1)
    speaker = F.coalesce(*[F.when(label == k, v) for k, v in SPEAKERS.items()])
    spoken = F.btrim(F.regexp_replace("_part", rf"^(?:{_LABEL}):", ""), F.lit(_WHITE))
    return transcripts.select("call_id", F.posexplode(parts).alias("turn", "_part")).select(
        "call_id", "turn", speaker.alias("speaker"), spoken.alias("text")
    )


def talk_stats(turns: DataFrame) -> DataFrame:
    """Turns, words, estimated minutes and share of the words per call and speaker.

    One aggregate per call with conditional sums; partial sums per task keep a very long call
    from travelling turn by turn.
    """
    speakers = sorted(set(SPEAKERS.values()))
    rows = turns.select("call_id", "speaker", X.word_count(F.col("text")).alias("_w")).filter(
        F.col("speaker").isNotNull()
    )
    wide = rows.groupBy("call_id").agg(
        F.sum("_w").alias("_all"),
        *[F.count_if(F.col("speaker") == s).alias(f"_t{i}") for i, s in enumerate(speakers)],
        *[F.sum(F.when(F.col("speaker") == s, F.col("_w"))).alias(f"_w{i}") for i, s in enumerate(speakers)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(s).alias("speaker"),
                F.col(f"_t{i}").alias("turns"),
                F.col(f"_w{i}").alias("words"),
                (F.col(f"_w{i}") / S.WORDS_PER_MINUTE).alias("minutes"),
                F.when(F.col("_all") > 0, F.col(f"_w{i}") / F.col("_all")).alias("share"),
            )
            for i, s in enumerate(speakers)
        ]
    )
    return wide.select("call_id", F.inline(cells)).filter(F.col("turns") > 0)
