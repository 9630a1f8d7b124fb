"""Dedup across runs: a persistent ledger of the event ids that runs have emitted.

The job runs every 30 minutes and deliveries overlap, so a run must drop events that
earlier runs emitted.  The ledger keeps, per run and hash bucket,

* ``ids/_run=<run>/_bucket=<b>``: the ids that the run emitted, and
* ``filters/_run=<run>/_bucket=<b>``: a Bloom filter of them, as (word, bits) rows of
  64 bits; each id sets four bits of one word, so a test is a join on the word and one mask.

Ids that no filter holds are new, and no id of an earlier run is read for them.  Filter hits
are verified against the ids of the buckets that have hits, so nothing is dropped by chance.

A rerun under the same run id ignores the run's own entries and replaces them: it emits the same events
again and adds nothing to the ledger.  Runs must not overlap in time; filters of finished runs are merged by
``compact_filters``, so that a test doesn't read one for each run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dedup import first_copies
from tidewater.session import delete_folders, partition_folder, path_exists, scratch_path

#: Buckets of the ledger, and words of a bucket's filter: 2^10 * 2^20 words hold 7 * 10^9 ids at 10 bits each.
#: Words without a bit take no space.  A ledger keeps the numbers it was begun with.
BUCKETS, WORDS = 1 << 10, 1 << 20
#: Names of merged filters begin so; no run may be named like that.
COMPACTED = "compacted-"
IDS = "id string, _run string, _bucket int"
FILTERS = "word int, bits bigint, _run string, _bucket int"


def _place(ids: Column, buckets: int, words: int) -> tuple[Column, Column, Column]:
    """Bucket, word in it and mask of an id."""
    h, g = F.xxhash64(ids), F.xxhash64(ids, F.lit(1))
    bucket = F.pmod(h, F.lit(buckets)).cast("int")
    word = F.pmod(F.shiftright(h, 24), F.lit(words)).cast("int")
    mask = F.lit(0).cast("long")
    for k in range(4):
        bit = F.shiftright(g, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return bucket, word, mask


class Ledger:
    """``path``: a folder that every executor can reach; it need not exist yet."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, words: int = WORDS):
        self.spark, self.path, self.buckets, self.words = spark, path.rstrip("/"), buckets, words

    def _read(self, table: str, schema: str) -> DataFrame:
        """Rows of all runs; partitions prune by run and bucket."""
        if not path_exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def ids(self) -> DataFrame:
        return self._read("ids", IDS)

    def filters(self) -> DataFrame:
        return self._read("filters", FILTERS)

    def unseen(self, events: DataFrame, run_id: str, staged: str, key: str = "event_id") -> DataFrame:
        """``events`` (one row an id) without those that another run emitted; rows without an id stay.

        Ids alone are tested and verified: only the filter hits among them are written, to ``staged``, and ids are
        read of the buckets with hits alone.  The rows move once, if at all, by id; what already lies by id stays.
        ``events`` is read for the test and again for its rows.
        """
        hits = self._hits(events.select(F.col(key).alias("_id")).where("_id IS NOT NULL"), run_id)
        hits.write.mode("overwrite").parquet(staged)
        hits = self.spark.read.schema(hits.schema).parquet(staged)
        asked = sorted(r[0] for r in hits.select("_bucket").distinct().collect())  # a number for each bucket at most
        if not asked:
            return events
        return events.join(self._seen(hits, run_id, asked), F.col(key) == F.col("_seen"), "left_anti")

    def _hits(self, ids: DataFrame, run_id: str) -> DataFrame:
        """(bucket, id) of the ids that the filter of another run may hold."""
        bucket, word, mask = _place(F.col("_id"), self.buckets, self.words)
        placed = ids.withColumns({"_bucket": bucket, "_word": word, "_mask": mask})
        # a word is a row for each run that set bits in it
        earlier = (self.filters().where(F.col("_run") != run_id).groupBy("_bucket", "word").agg(F.bit_or("bits").alias("bits"))
                   .select(F.col("_bucket").alias("_fb"), F.col("word").alias("_fw"), "bits"))
        found = placed.join(earlier, (F.col("_bucket") == F.col("_fb")) & (F.col("_word") == F.col("_fw")))
        return found.where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select("_bucket", "_id")

    def _seen(self, hits: DataFrame, run_id: str, asked: list[int]) -> DataFrame:
        """The ids among ``hits`` that other runs emitted, from the buckets ``asked``, which prune."""
        kept = self.ids().where((F.col("_run") != run_id) & F.col("_bucket").isin(asked))
        return (hits.join(kept.select(F.col("_bucket").alias("_kb"), "id"),
                          (F.col("_bucket") == F.col("_kb")) & (F.col("_id") == F.col("id")), "left_semi")
                .select(F.col("_id").alias("_seen")))

    def record(self, emitted: DataFrame, run_id: str, key: str = "event_id") -> None:
        """The run's ids and their filter; what the run had recorded before is replaced."""
        bucket, word, mask = _place(F.col("id"), self.buckets, self.words)
        rows = (emitted.where(F.col(key).isNotNull()).select(F.col(key).alias("id"))
                .withColumns({"_bucket": bucket, "word": word, "mask": mask}))
        words = rows.groupBy("_bucket", "word").agg(F.bit_or("mask").alias("bits"))
        self._write("ids", rows.select("id", "_bucket"), run_id, "id")
        self._write("filters", words, run_id, "word")

    def compact_filters(self, runs: list[str]) -> None:
        """One filter in place of those of ``runs`` (finished ones) and of earlier compactions.

        The old ones go after the new one is written: at any time every id is in some filter.
        """
        own = F.col("_run").startswith(COMPACTED)
        old = [r[0] for r in self.filters().where(own).select("_run").distinct().collect()]  # one name, or few
        merged = (self.filters().where(own | F.col("_run").isin(runs)).groupBy("_bucket", "word")
                  .agg(F.bit_or("bits").alias("bits")))
        self._write("filters", merged, f"{COMPACTED}{uuid.uuid4().hex}", "word")
        delete_folders(self.spark, [self._folder("filters", r) for r in [*runs, *old]])

    def _folder(self, table: str, run_id: str) -> str:
        return f"{self.path}/{table}/{partition_folder(self.spark, '_run', run_id)}"

    def _write(self, table: str, rows: DataFrame, run_id: str, order: str) -> None:
        (rows.hint("rebalance", "_bucket").sortWithinPartitions("_bucket", order).write.mode("overwrite")
         .partitionBy("_bucket").parquet(self._folder(table, run_id)))


def dedup_run(events: DataFrame, ledger: Ledger, run_id: str, output: str, key: str = "event_id") -> DataFrame:
    """The events of one run that are new: deduplicated in itself and against earlier runs.

    Written to ``output/_run=<run_id>`` (a rerun replaces it), then recorded from there, so a run that
    fails in between is simply run again.  Events without an id pass through one by one and are not shuffled.
    The rows with one are shuffled once, as the survivors of their ids; ``events`` is read more than once and must give the same rows.
    """
    path = f"{output.rstrip('/')}/{partition_folder(ledger.spark, '_run', run_id)}"
    staged = scratch_path(ledger.spark, "ledger-hits")
    new = ledger.unseen(first_copies(events, key), run_id, staged, key)
    new.union(events.where(F.col(key).isNull())).write.mode("overwrite").parquet(path)
    delete_folders(ledger.spark, [staged])
    emitted = ledger.spark.read.schema(events.schema).parquet(path)
    ledger.record(emitted, run_id, key)
    return emitted
