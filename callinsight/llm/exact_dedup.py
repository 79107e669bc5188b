"""Exact deduplication with a disk-backed keyed state that never expires.

Every document arrives as a narrow row (digest of its text, id, content locator). A Structured Streaming
aggregation in the RocksDB state store keeps, for each digest, the smallest id of the first delivery that had it, where
that row's content lies and how often the digest came. Equal digests are only candidates: the full bytes of
all their rows are compared before anything is dropped; those of earlier deliveries are read where the state
locates them.

The texts themselves never enter the state or the stream. Bytes are compared by folding equal
(digest, text) pairs inside each task before the shuffle, so a group of copies that holds a third of
the corpus costs one row per task; rows whose digest occurs once are not read into the comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callinsight.llm.common import columns, external_id, fresh, internal_id, least_row, scratch, shared_folder, text_of, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVAL = "delivery long, id long, digest binary, bytes int, locator string, row long"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class ExactDedup:
    """``digest``: from the normalised text to the state's key (replaced in tests to force collisions).
    ``bytes_per_trigger``: how much of the arrivals one micro-batch takes, which bounds its shuffle."""

    digest: Callable[[Column], Column] = sha256
    bytes_per_trigger: int = 8 << 30

    def arrivals(self, docs: DataFrame, delivery: int = 0) -> DataFrame:
        text = normalised(text_of())
        return docs.select(
            F.lit(delivery).cast("long").alias("delivery"),
            internal_id().alias("id"),
            self.digest(text).alias("digest"),
            F.octet_length(text).alias("bytes"),
            F.input_file_name().alias("locator"),
            F.monotonically_increasing_id().alias("row"),
        )

    def update_state(self, spark: SparkSession, arrivals_path: str, checkpoint: str) -> None:
        """Feed all files of ``arrivals_path`` that ``checkpoint`` has not seen into the state.

        Called again after more arrivals were appended, it continues from the same state.
        """
        session = spark.newSession()  # the settings below stay in it
        for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
            session.conf.set(key, spark.conf.get(key))
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "128")
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # many small stores
        stream = (
            session.readStream.schema(ARRIVAL)
            .option("maxBytesPerTrigger", str(self.bytes_per_trigger))
            .parquet(arrivals_path)
        )
        state = stream.groupBy("digest").agg(
            F.min(F.struct("delivery", "id", "row", "bytes", "locator")).alias("first"), F.count("*").alias("seen")
        )
        query = (
            state.writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    def read_state(self, spark: SparkSession, checkpoint: str) -> DataFrame:
        """(digest, keep_delivery, keep_id, keep_row, bytes, locator, group_size), one row per digest ever seen."""
        state = spark.read.format("statestore").load(checkpoint)
        first, seen = state.schema["value"].dataType.fieldNames()
        return state.select(
            F.col("key.digest").alias("digest"),
            F.col(f"value.{first}.delivery").alias("keep_delivery"),
            F.col(f"value.{first}.id").alias("keep_id"),
            F.col(f"value.{first}.row").alias("keep_row"),
            F.col(f"value.{first}.bytes").alias("bytes"),
            F.col(f"value.{first}.locator").alias("locator"),
            F.col(f"value.{seen}").alias("group_size"),
        )

    def collided(self, docs: DataFrame, groups: DataFrame) -> DataFrame:
        """(digest), digests that stand for more than one text: full bytes of all hits are compared."""
        hits = groups.where("group_size > 1").select(F.xxhash64("digest").alias("hit"))
        hits = written(hits, "hits")  # its file size tells Spark whether it can be broadcast
        texts = docs.select(normalised(text_of()).alias("text")).select(self.digest(F.col("text")).alias("digest"), "text")
        texts = texts.withColumn("hit", F.xxhash64("digest")).join(hits, "hit", "left_semi")
        distinct = texts.groupBy("digest", "text").agg(F.count("*").alias("n"))
        return distinct.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").select("digest")

    def groups_of(self, docs: DataFrame) -> DataFrame:
        """(doc_id, keep_id, group_size, kept, digest), one row per row of ``docs`` (doc_id, text).

        Of equal texts the row with the smallest doc_id stays; of rows that repeat both, one. NULL and
        empty texts are equal. Rows without an id stay only where no row of their group has one.
        """
        spark = docs.sparkSession
        path, checkpoint = shared_folder(spark, "arrivals"), shared_folder(spark, "dedup-state", keep=True)
        self.arrivals(docs).write.parquet(path)
        arrivals = spark.read.schema(ARRIVAL).parquet(path)
        self.update_state(spark, path, checkpoint)
        groups = written(self.read_state(spark, checkpoint), "groups")
        collided = written(self.collided(docs, groups), "collided")
        sound = arrivals.join(groups.drop("bytes", "locator"), "digest")
        sound = sound.withColumn("kept", (F.col("id") == F.col("keep_id")) & (F.col("row") == F.col("keep_row")))
        columns = ["id", "keep_id", "group_size", "kept", "digest"]
        if collided.head(1):
            sound = sound.join(collided, "digest", "left_anti").select(columns).unionByName(self._by_bytes(docs, collided))
        return sound.select(
            external_id("id").alias("doc_id"), external_id("keep_id").alias("keep_id"), "group_size", "kept", "digest"
        )

    def deliver(self, docs: DataFrame, folder: str, read: Callable[[list[str]], DataFrame] | None = None) -> DataFrame:
        """(doc_id, kept, keep_delivery, keep_id, digest): which rows of a further delivery are new to ``folder``.

        ``folder`` lies where all executors reach it and holds the state of all deliveries so far; it is made by the first.
        A text that an earlier delivery had is a copy of that one, whatever its id; of equal texts within the delivery the
        row with the smallest id stays. ``docs`` must be read from files, and those of earlier deliveries must still be
        there: of each digest met again, the bytes are read from the file that the state names, by ``read``
        (Parquet by default), and compared. Where they differ the row is new; the state goes on to hold the first text of
        that digest, so further deliveries of the other one are new again. One delivery at a time.
        """
        spark = docs.sparkSession
        number = self._deliveries(spark, folder)
        path, checkpoint = f"{folder}/arrivals", f"{folder}/state"
        self.arrivals(docs, number).write.mode("append").partitionBy("delivery").parquet(path)
        self.update_state(spark, path, checkpoint)
        mine = spark.read.schema(ARRIVAL).parquet(path).where(F.col("delivery") == number)
        groups = written(self.read_state(spark, checkpoint).join(mine.select("digest").distinct(), "digest", "left_semi"), "groups", keep=True)
        earlier = groups.where(F.col("keep_delivery") < number)

        # What the digests met again stand for, from the files that hold the first of each.
        files = [r["locator"] for r in earlier.select("locator").distinct().collect()]
        texts = lambda df: df.select(internal_id().alias("id"), normalised(text_of()).alias("text")).withColumn("digest", self.digest(F.col("text")))
        if files:
            kept_before = texts((read or (lambda names: spark.read.parquet(*names)))(files)).withColumnRenamed("id", "keep_id")
            known = written(kept_before.join(earlier.select("digest", "keep_id"), ["digest", "keep_id"]).select("digest", "text", "keep_id").distinct(), "known", keep=True)
        else:
            known = spark.createDataFrame([], "digest binary, text string, keep_id long")
        # Rows of digests with copies anywhere are settled by their bytes, all others are new.
        busy = groups.where(f"group_size > 1 or keep_delivery < {number}").select("digest")
        rows = texts(docs).join(busy, "digest")
        one = rows.groupBy("digest", "text").agg(F.min("id").alias("first"))
        old = known.groupBy("digest", "text").agg(F.min("keep_id").alias("old_id"))
        settled = one.join(old, ["digest", "text"], "left").join(groups.select("digest", F.col("keep_delivery").alias("since")), "digest")
        settled = settled.select(
            "digest", F.sha2("text", 512).alias("bytes"), F.coalesce("old_id", "first").alias("keep_id"),
            F.when(F.col("old_id").isNotNull(), F.col("since")).otherwise(number).alias("keep_delivery"),
        )
        # Of rows that repeat id and text one is the first: narrow rows, told apart by the text's own digest.
        first = Window.partitionBy("digest", "bytes", "id").orderBy(F.lit(0))
        met = rows.select("id", "digest", F.sha2("text", 512).alias("bytes")).join(settled, ["digest", "bytes"])
        met = met.withColumn("kept", (F.col("keep_delivery") == number) & (F.col("id") == F.col("keep_id")) & (F.row_number().over(first) == 1))
        alone = mine.join(busy, "digest", "left_anti").select("id", "digest", F.col("id").alias("keep_id"), F.lit(number).alias("keep_delivery"), F.lit(True).alias("kept"))
        done = met.select("id", "digest", "keep_id", "keep_delivery", "kept").unionByName(alone)
        done = written(done, "delivered", keep=True)
        return done.select(external_id("id").alias("doc_id"), "kept", F.col("keep_delivery").cast("long").alias("keep_delivery"), external_id("keep_id").alias("keep_id"), "digest")

    def _deliveries(self, spark: SparkSession, folder: str) -> int:
        """How many deliveries the folder has."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/arrivals")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return 0
        return sum(s.getPath().getName().startswith("delivery=") for s in files.listStatus(path))

    def _by_bytes(self, docs: DataFrame, collided: DataFrame) -> DataFrame:
        rows = docs.select(internal_id().alias("id"), normalised(text_of()).alias("text"))
        rows = rows.withColumn("digest", self.digest(F.col("text"))).join(collided, "digest")
        same = Window.partitionBy("digest", "text")
        return rows.select(
            "id",
            F.min("id").over(same).alias("keep_id"),
            F.count("*").over(same).alias("group_size"),
            (F.row_number().over(same.orderBy("id")) == 1).alias("kept"),
            "digest",
        )


def deduplicate(docs: DataFrame, operator: ExactDedup | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only ids with something to drop are joined, so the texts are not shuffled where these are few. Ids
    of which some rows stay and some go are settled row by row; of rows that share id and text the one stays whose
    columns are least. The tables of the decision are removed once it is written.
    """
    operator = operator or ExactDedup()
    key, mark = fresh("_id", docs), fresh("_digest", docs)
    with scratch(docs.sparkSession):
        decided = operator.groups_of(docs).select(internal_id().alias(key), "digest", "kept")
        per_id = decided.groupBy(key).agg(F.sum(F.col("kept").cast("long")).alias("stay"), F.count("*").alias("rows"))
        touched = written(per_id.where("stay < rows").select(key, "stay"), "touched", keep=True)
        mixed = touched.where("stay > 0").select(key)
        stay = written(decided.where("kept").join(mixed, key).select(key, F.col("digest").alias(mark)), "stay", keep=True)
    tagged = docs.withColumn(key, internal_id())
    untouched = tagged.join(touched.select(key), key, "left_anti").select(columns(docs))
    if not mixed.head(1):
        return untouched
    rows = tagged.withColumn(mark, operator.digest(normalised(text_of()))).join(stay, [key, mark])
    return untouched.unionByName(least_row(rows, [key, mark], docs))
