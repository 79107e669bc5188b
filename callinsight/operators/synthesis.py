"""Synthetic people and calls with ground truth, from row keys alone.

Every value is drawn by hashing the row's key, so a batch can be generated at any size, in
parallel, and a lost task reproduces its rows exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callinsight import schemas as S
from callinsight.functions import sampling as R
from callinsight.functions import scalars as X

FIRST_NAMES = {
    "en": ["Alice", "Brian", "Carol", "David", "Erin", "Frank", "Grace", "Henry", "Irene", "Jack", "Karen", "Liam"],
    "es": ["Ana", "Bruno", "Carmen", "Diego", "Elena", "Felipe", "Gloria", "Hugo", "Isabel", "Javier", "Lucia", "Mateo"],
}
LAST_NAMES = {
    "en": ["Adams", "Baker", "Clark", "Dixon", "Evans", "Foster", "Green", "Harris", "Irwin", "Jones", "King", "Lewis"],
    "es": ["Alonso", "Blanco", "Castro", "Delgado", "Flores", "Gil", "Herrera", "Iglesias", "Lopez", "Mora", "Navarro", "Ortega"],
}
# (city, latitude, longitude)
CITIES = [
    ("Austin, TX", "30.27", "-97.74"),
    ("Boston, MA", "42.36", "-71.06"),
    ("Chicago, IL", "41.88", "-87.63"),
    ("Denver, CO", "39.74", "-104.99"),
    ("Houston, TX", "29.76", "-95.37"),
    ("Los Angeles, CA", "34.05", "-118.24"),
    ("Miami, FL", "25.76", "-80.19"),
    ("New York, NY", "40.71", "-74.01"),
    ("Phoenix, AZ", "33.45", "-112.07"),
    ("Portland, OR", "45.52", "-122.68"),
    ("Seattle, WA", "47.61", "-122.33"),
    ("Atlanta, GA", "33.75", "-84.39"),
]

# What the agent does about an upsale: name -> (attempted, succeeded, instruction).
UPSALE_OPTIONS = {
    "none": (False, False, "offers nothing beyond the current service"),
    "declined": (True, False, "offers an additional service, which the client declines"),
    "accepted": (True, True, "offers an additional service, which the client accepts"),
}

PROMPT = (
    "Write a phone call in {language} between the internet provider's agent {agent_name} and the client "
    "{client_name} (e-mail {client_email}, phone {client_phone}).\n"
    "Start each line with 'Agent:' or 'Client:' and use {min_words} to {max_words} words.\n"
    "The client calls about {topic}. The agent {concern} the concern and {upsale}.\n"
    "The client's tone is {client_tone}, the agent's tone is {agent_tone}.\n"
    "Agent skills from 1 to 5: empathy {empathy}, professionalism {professionalism}, kindness {kindness}, "
    "effective communication {effective_communication}, active listening {active_listening}, "
    "customization {customization}."
)


@dataclass(frozen=True)
class CallSettings:
    """Parameters of a generated batch; dates are ``MM.dd.yyyy``, times ``HH:mm``."""

    language: str = "en"
    min_minutes: int = 2
    max_minutes: int = 5
    from_date: str = "09.01.2024"
    to_date: str = "08.31.2025"
    from_time: str = "09:00"
    to_time: str = "17:00"
    seed: str = "call"


def _seconds(hhmm: str) -> int:
    hours, minutes = hhmm.split(":")
    return int(hours) * 3600 + int(minutes) * 60


def _pool(tag: str, key: Column, pool: list[str]) -> Column:
    return R.pick(tag, key, pool)


def synthetic_clients(keys: DataFrame, language: str = "en", key: str = "id") -> DataFrame:
    """One client per key: digits-only unique id, and a city with its own coordinates."""
    k = F.col(key).cast("bigint")
    client_id = (F.lit(10_000_000) + k).cast("string")
    first = _pool("first", k, FIRST_NAMES[language])
    last = _pool("last", k, LAST_NAMES[language])
    city = F.get(
        F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("c", "la", "lo"), row)]) for row in CITIES]),
        R.below("city", k, len(CITIES)).cast("int"),
    )
    return keys.select(
        client_id.alias("client_id"),
        first.alias("first_name"),
        last.alias("last_name"),
        F.concat(
            F.lit("555-"),
            F.lpad(R.below("phone_a", k, 1000).cast("string"), 3, "0"),
            F.lit("-"),
            F.lpad(R.below("phone_b", k, 10000).cast("string"), 4, "0"),
        ).alias("phone_number"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), client_id, F.lit("@example.com")).alias("email"),
        city["c"].alias("client_city"),
        city["la"].alias("latitude"),
        city["lo"].alias("longitude"),
    )


def synthetic_agents(keys: DataFrame, language: str = "en", key: str = "id") -> DataFrame:
    k = F.col(key).cast("bigint")
    return keys.select(
        (F.lit(10_000_000) + k).cast("string").alias("agent_id"),
        _pool("agent_first", k, FIRST_NAMES[language]).alias("first_name"),
        _pool("agent_last", k, LAST_NAMES[language]).alias("last_name"),
    )


def with_dense_index(people: DataFrame, key: str) -> DataFrame:
    """Add ``_index``, numbering the rows 0..n-1 by (hash bucket of the key, key).

    A row's number is its place within its bucket plus the size of the buckets before it. The
    4,096 buckets are ranked in parallel; only their sizes are summed in one place.
    """
    bucketed = people.withColumn("_bucket", F.substring(F.md5(F.col(key).cast("string")), 1, 3))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        "_bucket", (F.sum("_size").over(W.orderBy("_bucket")) - F.col("_size")).alias("_offset")
    )
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(key))
    return (
        bucketed.withColumn("_place", place)
        .join(offsets, "_bucket")
        .withColumn("_index", F.col("_offset") + F.col("_place") - 1)
        .drop("_bucket", "_place", "_offset")
    )


def _paired(calls: DataFrame, people: DataFrame, key: str, tag: str, columns: dict[str, str]) -> DataFrame:
    """Give each call a random person (with replacement) by joining on a drawn index."""
    n = people.select(F.count("*")).scalar()
    indexed = with_dense_index(people, key).select(
        F.col("_index").alias(f"_{tag}_index"), *[F.col(c).alias(a) for c, a in columns.items()]
    )
    drawn = calls.withColumn(f"_{tag}_index", R.below(tag, F.col("id"), n))
    return drawn.join(indexed, f"_{tag}_index").drop(f"_{tag}_index")


def synthetic_calls(
    keys: DataFrame, agents: DataFrame, clients: DataFrame, settings: CallSettings = CallSettings()
) -> DataFrame:
    """One call per key (column ``id``): metadata, ground truth and the prompt for its text."""
    k = F.col("id")
    days = [X.parse_day(F.lit(d)) for d in (settings.from_date, settings.to_date)]
    seconds = R.random_second("time", k, _seconds(settings.from_time), _seconds(settings.to_time))
    option = F.col("_upsale")
    options = {
        name: F.create_map(*[F.lit(x) for o, v in UPSALE_OPTIONS.items() for x in (o, v[i])])
        for i, name in enumerate(("attempted", "succeeded", "instruction"))
    }
    call_id = R.hashed_id(settings.seed, k)
    drawn = keys.select(
        k,
        call_id.alias("call_id"),
        X.text_file_name(call_id).alias("text_file"),
        R.random_day("date", k, *days).alias("date"),
        X.clock(seconds).alias("time"),
        F.lit(settings.language).alias("language"),
        R.pick("topic", k, S.TOPICS).alias("topic"),
        R.pick("concern", k, [True, False]).alias("concern_addressed"),
        R.pick("upsale", k, list(UPSALE_OPTIONS)).alias("_upsale"),
        *[R.pick(c, k, S.TONES).alias(c) for c in S.TONE_COLUMNS],
        *[R.score(c, k).alias(c) for c in S.SCORE_COLUMNS],
    ).withColumns(
        {"agent_tries_upsale": options["attempted"][option], "agent_succeeds_upsale": options["succeeded"][option]}
    )
    paired = _paired(drawn, agents, "agent_id", "agent", {"agent_id": "agent_id", "first_name": "_af", "last_name": "_al"})
    paired = _paired(
        paired,
        clients,
        "client_id",
        "client",
        {"client_id": "client_id", "first_name": "_cf", "last_name": "_cl", "email": "_ce", "phone_number": "_cp"},
    )
    prompt = X.render(
        PROMPT,
        language=F.col("language"),
        agent_name=X.full_name(F.col("_af"), F.col("_al")),
        client_name=X.full_name(F.col("_cf"), F.col("_cl")),
        client_email=F.col("_ce"),
        client_phone=F.col("_cp"),
        min_words=F.lit(settings.min_minutes * S.WORDS_PER_MINUTE),
        max_words=F.lit(settings.max_minutes * S.WORDS_PER_MINUTE),
        topic=F.col("topic"),
        concern=F.when(F.col("concern_addressed"), "resolves").otherwise("does not resolve"),
        upsale=options["instruction"][option],
        **{c: F.col(c) for c in S.TONE_COLUMNS + S.SCORE_COLUMNS},
    )
    return paired.withColumn("prompt", prompt).drop("id", "_upsale", "_af", "_al", "_cf", "_cl", "_ce", "_cp")


def metadata(calls: DataFrame) -> DataFrame:
    return calls.select(*S.METADATA.fieldNames())


def ground_truths(calls: DataFrame) -> DataFrame:
    """Ground truth per call; client and agent ids each under their own name."""
    return calls.select(*S.GROUND_TRUTHS.fieldNames())
