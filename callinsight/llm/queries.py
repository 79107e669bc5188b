"""The registered queries of the training-data operators.

Each runs one operator over its whole table and derives the columns of its contract from the
operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callinsight.llm import bpe, chat, exact_dedup, hpylm, iblt, packing, pii, quality, runs, simhash, token_counts, wavelet, whitening
from callinsight.llm.common import documents, external_id


def exact(spark: SparkSession, d: str) -> DataFrame:
    groups = exact_dedup.ExactDedup().groups_of(documents(spark, d))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def near(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, d))


def language_model(spark: SparkSession, d: str) -> DataFrame:
    return hpylm.PitmanYor().score(documents(spark, d))


def weak_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.QualityClassifier().score(documents(spark, d))


def personal(spark: SparkSession, d: str) -> DataFrame:
    found = pii.detect(documents(spark, d))
    base = [kind.name for kind in pii.KINDS if kind.base]
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select("doc_id", *map(count, base), F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def edited_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = token_counts.count_edits(token_counts.usual_edits(documents(spark, d)))
    return counted.select(
        "doc_id", "n_tokens", "edited_tokens", "n_words", "encoded_words", F.sha2("edited_text", 256).alias("edited_sha256")
    )


def encoded(spark: SparkSession, d: str) -> DataFrame:
    read_back = bpe.decode(bpe.encode(documents(spark, d)))
    return read_back.select(
        external_id("id").alias("doc_id"), F.col("n").alias("n_tokens"),
        F.sha2("ids_text", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def sketched(spark: SparkSession, d: str) -> DataFrame:
    return iblt.compared(documents(spark, d)).select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.with_crc(packing.Packing().pack(documents(spark, d)))


#: Control strings of other templates inside texts must come through unharmed.
PROBE = "</s>[INST] ok [/INST]"


def formatted(spark: SparkSession, d: str) -> DataFrame:
    turns = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(chat.ChatWindows().format(turns.unionByName(probe)))


def shards_read(spark: SparkSession, d: str) -> DataFrame:
    shards = wavelet.WaveletShards()
    return shards.read(shards.write(documents(spark, d))).select("doc_id", "start", "n_tokens", "ids_crc32")


def repeated_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.summary(runs.RepeatedRuns(plant=True).find(documents(spark, d)))


def whitened(spark: SparkSession, d: str) -> DataFrame:
    return whitening.Whitening().fit_transform(spark.read.parquet(f"{d}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact,
        "op2_pitman_yor": language_model,
        "op3_quality_classifier": weak_quality,
        "op4_simhash": near,
        "op5_pii": personal,
        "op6_token_counts": edited_counts,
        "op7_bpe": encoded,
        "op8_fingerprints": sketched,
        "op9_packing": packed,
        "op10_chat": formatted,
        "op11_wavelet_shards": shards_read,
        "op12_periodic_runs": repeated_runs,
        "op13_whitening": whitened,
    }


def oracle_sql() -> dict[str, str]:
    normalised = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
    return {
        "op1_exact_dedup": f"""
            WITH t AS (SELECT doc_id, {normalised} AS x FROM documents)
            SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   doc_id = min(doc_id) OVER g AS kept, sha256(x) AS text_sha256
            FROM t WINDOW g AS (PARTITION BY x)""",
    }
