"""The newest row of each key of a stream's table, kept in buckets beside the table's batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.schema import TABLES
from tillwright.sinks import folders
from tillwright.sinks.tables import RANGE_BATCHES, FileStore, newest_by_key


class CurrentRows:
    """One row per key, as ``FileStore.latest`` gives it, but merged when a batch is written.

    Keys are hashed into ``buckets``, each a partition of the folder. A batch is merged into the buckets of its
    keys, the others are not read, and reading needs no aggregation of the history. Choose
    ``buckets`` so that one holds some hundred MB; with another number the rows are built anew.

    The batches stay the truth. A merge that fails leaves a mark: until the next merge, which then
    builds all buckets anew, reads aggregate the batches. Merge one batch of a table at a time.
    """

    def __init__(self, store: FileStore, table: str, stream_id: str, buckets: int = 64, width: int = RANGE_BATCHES):
        self.store, self.table, self.stream_id, self.buckets, self.width = store, table, stream_id, buckets, width
        self.key = list(TABLES[table].key)
        self.folder = f"{store.path(table)}/current/stream_id={stream_id}/of={buckets}"

    def merge(self, spark: SparkSession, batch_id: int) -> None:
        """Bring the rows up to date with a batch that was written, for the first time or again.

        Batches may come in any order. The first merge takes in all batches that there are. A batch without
        rows changes nothing, unless it had some before: keys that have lost their row get their older one back.
        """
        if not self._whole(spark):
            return self.rebuild(spark)
        rows = self.store.lookup(spark, self.table, batch_id, self.stream_id, self.width)
        stored = self._stored(spark)
        redone = stored.filter(F.col("batch_id") == batch_id).select(*self.key)
        if not redone.isEmpty():
            # An earlier attempt of the batch gave these; what they hid is in the history only.
            history = self.store.read(spark, self.table, self.stream_id)
            rows = rows.unionByName(history.join(redone, self.key, "left_semi").select(*rows.columns))
        fresh = self._bucketed(newest_by_key(rows, self.key)).persist()
        try:
            if not redone.join(fresh, self.key, "left_anti").isEmpty():
                # A key has no row left at all, and its bucket may have none; that needs all buckets.
                return self.rebuild(spark)
            # As many numbers as there are buckets, at most.
            touched = [row["bucket"] for row in fresh.select("bucket").distinct().collect()]
            if touched:
                older = stored.filter(F.col("bucket").isin(touched) & (F.col("batch_id") != batch_id))
                self._write(spark, older.unionByName(fresh.select(*older.columns)), "dynamic", batch_id)
        finally:
            fresh.unpersist()

    def rebuild(self, spark: SparkSession) -> None:
        """All buckets from all batches."""
        self._write(spark, self._bucketed(self.store.latest(spark, self.table, self.stream_id)), "static", "all")

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row of each key."""
        if not self._whole(spark):
            return self.store.latest(spark, self.table, self.stream_id)
        return self._stored(spark).drop("bucket")

    def get(self, spark: SparkSession, **key: object) -> DataFrame:
        """The row of one key, from its bucket; the others are not listed."""
        if set(key) != set(self.key):
            raise ValueError(f"the key of {self.table} is {', '.join(self.key)}")
        columns = {**TABLES[self.table].columns, "batch_id": "bigint"}
        wanted = {name: F.lit(key[name]).cast(columns[name]) for name in self.key}
        rows = self.read(spark)
        if self._whole(spark):
            rows = self._stored(spark).filter(F.col("bucket") == self._bucket(*wanted.values())).drop("bucket")
        for name, value in wanted.items():
            rows = rows.filter(F.col(name) == value)
        return rows

    def _bucket(self, *key):
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", self._bucket(*[F.col(name) for name in self.key]))

    def _whole(self, spark: SparkSession) -> bool:
        return folders.exists(spark, self.folder) and not folders.exists(spark, self._mark)

    @property
    def _mark(self) -> str:
        return f"{self.folder}.unfinished"

    def _stored(self, spark: SparkSession) -> DataFrame:
        return self.store.reader(spark, {**TABLES[self.table].columns, "batch_id": "bigint", "bucket": "int"}).load(self.folder)

    def _write(self, spark: SparkSession, rows: DataFrame, overwrite: str, what: object) -> None:
        # Keys of a bucket meet in its task, so the aggregate below needs no shuffle of its own.
        newest = newest_by_key(rows.repartition("bucket"), self.key, also=["bucket"])
        folders.write_once(spark, self._mark, str(what))
        writer = self.store.writer(newest.sortWithinPartitions("bucket", *self.key), "overwrite")
        writer.option("partitionOverwriteMode", overwrite).partitionBy("bucket").save(self.folder)
        folders.delete(spark, self._mark)
