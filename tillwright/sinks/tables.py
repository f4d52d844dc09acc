"""Result tables: appended, replaced per batch, compacted, looked up by batch, rolled up by key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from tillwright.operators.keyed import has_whole_key, split_on_key
from tillwright.schema import TABLES
from tillwright.sinks import folders

# Tables that take any row: their keys have a stand-in for null, or none is needed.
KEYLESS = ("zero_success_statuses", "rejected_rows", "daily_state", "read_ledger")

# Batches in a compacted file range: a day of 10-second triggers.
RANGE_BATCHES = 8640

_NO_BATCH = "__HIVE_DEFAULT_PARTITION__"
_REJECT = {"_reason": "string", "_payload": "string"}


def conform(rows: DataFrame, table: str) -> DataFrame:
    """The columns of a result table, in order and typed; a missing column is an error."""
    return rows.select(*[F.col(name).cast(dtype) for name, dtype in TABLES[table].columns.items()])


def newest_by_key(rows: DataFrame, key: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """One row per key, of the highest batch; in a batch the greatest in column order. ``also`` depends on the key."""
    fixed = [*also, *key]
    version = ["batch_id", *[name for name in rows.columns if name not in ("batch_id", *fixed)]]
    # One struct that is both the order and the row: each column crosses the shuffle once.
    newest = rows.groupBy(*fixed).agg(F.max(F.struct(*[c for c in version if c not in fixed])).alias("_newest"))
    return newest.select(*fixed, "_newest.*").select(*rows.columns)


class Store(Protocol):
    """What a stream needs of a place for result tables. ``claim``, as in ``FileStore``, is optional."""

    def replace_batch(self, rows: DataFrame, table: str, stream_id: str, batch_id: int) -> None: ...


class FileStore:
    """Tables as folders, one subfolder per stream and batch.

    ``replace_batch`` overwrites exactly one subfolder. A retried batch therefore replaces what its
    first attempt wrote, complete or not, even where the retry has no rows.

    A table's folder holds ``stream_id=*/batch_id=*`` of streams, ``batches/batch_id=*`` of
    ``replace_batches``, ``appended`` of ``append``, ``rollup`` of rollups, and ``compacted`` batches.
    Outside streams, rows that a keyed table cannot hold lie in the same files as the others, with
    the reason and the row as JSON. So one write of a batch replaces both kinds; ``rejected_rows``
    without a stream reads them from all tables.
    """

    def __init__(self, root: str, fmt: str = "parquet", options: Mapping[str, str] | None = None):
        self.root, self.fmt, self.options = root.rstrip("/"), fmt, dict(options or {})

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _batches(self, table: str, stream_id: str | None) -> str:
        return f"{self.path(table)}/" + ("batches" if stream_id is None else f"stream_id={stream_id}")

    def batch_path(self, table: str, batch_id: int, stream_id: str | None = None) -> str:
        return f"{self._batches(table, stream_id)}/batch_id={batch_id}"

    def claim(self, spark: SparkSession, stream_id: str, query_id: str) -> None:
        """Make a streaming query the owner of a stream's tables, or raise if another one is.

        A query's id lives in its checkpoint. With a lost or a new checkpoint, batch ids start at 0
        again, and their batches would replace those that the first query wrote. Of two queries that
        start together, one becomes the owner.
        """
        owner = folders.write_once(spark, f"{self.root}/_owners/stream_id={stream_id}", query_id)
        if owner != query_id:
            raise ValueError(
                f"stream {stream_id!r} in {self.root} belongs to query {owner}, not {query_id}: "
                "go on from its checkpoint, or choose another stream id"
            )

    # --- writing -------------------------------------------------------------

    def _with_rejects(self, rows: DataFrame, table: str) -> DataFrame:
        """The rows with ``_reason`` and ``_payload``, which are null but for rows without a whole key."""
        if table in KEYLESS:
            return rows
        key, names = TABLES[table].key, rows.columns
        missing = F.concat_ws(", ", *[F.when(F.col(name).isNull(), F.lit(name)) for name in key])
        whole = has_whole_key(key)
        payload = F.to_json(F.struct(*[name for name in names if name != "batch_id"]), {"ignoreNullFields": "false"})
        return rows.select(
            *names, F.when(~whole, F.concat(F.lit("null key: "), missing)).alias("_reason"), F.when(~whole, payload).alias("_payload")
        )

    def writer(self, rows: DataFrame, mode: str):
        return rows.write.format(self.fmt).options(**self.options).mode(mode)

    def append(self, rows: DataFrame, table: str) -> None:
        """Add rows. Repeating it duplicates them; streams use ``replace_batch``.

        Rows with a null in the table's key are kept as rejected ones.
        """
        self.writer(self._with_rejects(rows, table), "append").save(f"{self.path(table)}/appended")

    def replace_batch(self, rows: DataFrame, table: str, stream_id: str, batch_id: int) -> None:
        """Make ``rows`` the whole content of one batch of one stream."""
        self.writer(rows.drop("batch_id"), "overwrite").save(self.batch_path(table, batch_id, stream_id))

    def replace_batches(self, rows: DataFrame, table: str) -> None:
        """Replace every batch that occurs in ``rows``, with its rejects, and leave the others as they are.

        Rows are computed once, and range-partitioned on the table's key first, so a batch becomes few
        files, each a sorted run, and a large batch is written by several tasks.
        """
        key = TABLES[table].key
        dealt = self._with_rejects(rows, table).repartitionByRange(*key).sortWithinPartitions(*key)
        writer = self.writer(dealt, "overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").save(self._batches(table, None))

    def replace_rollup(self, rows: DataFrame, table: str, now: datetime) -> None:
        """Store a rollup under its key, stamped: a row replaces the stored one of equal key.

        The table is partitioned (daily rows by month), and only partitions with new rows are written
        anew, from their older rows and the new ones. Spark writes them aside and moves them into
        place, so a rollup that fails leaves the last one as it was.
        """
        spark, key = rows.sparkSession, TABLES[table].key
        stamped = rows.withColumns({name: F.lit(now) for name in ("created_at", "last_updated")})
        kept, _ = split_on_key(conform(stamped, table), key)
        # Read twice below, and computed once: a rollup has a row per key, not per record.
        kept = kept.withColumn("part", self._part(table)).persist()
        try:
            stored = self._rollup(spark, table)
            if stored is not None:
                touched = kept.select("part").distinct()
                older = stored.join(touched, "part", "left_semi").join(kept.select(*key), list(key), "left_anti")
                rows = older.select(*kept.columns).unionByName(kept)
            else:
                rows = kept
            writer = self.writer(rows.repartition("part"), "overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("part").save(f"{self.path(table)}/rollup")
        finally:
            kept.unpersist()

    def _part(self, table: str) -> Column:
        return F.substring("date", 1, 7) if table == "daily_aggregates" else F.lit("all")

    def _rollup(self, spark: SparkSession, table: str) -> DataFrame | None:
        folder = f"{self.path(table)}/rollup"
        if not folders.exists(spark, folder):
            return None
        return self.reader(spark, {**TABLES[table].columns, "part": "string"}).load(folder)

    def read_rollup(self, spark: SparkSession, table: str) -> DataFrame:
        """The rollup as last stored; empty before that."""
        rows = self._rollup(spark, table)
        return self._empty(spark, TABLES[table].columns) if rows is None else rows.drop("part")

    # --- compaction ----------------------------------------------------------

    def _compacted(self, table: str, stream_id: str | None) -> str:
        return f"{self.path(table)}/compacted/" + ("batches" if stream_id is None else f"stream_id={stream_id}")

    def _versions(self, spark: SparkSession, table: str, stream_id: str | None) -> dict[int, list[str]]:
        """Per range of batches its complete versions, the newest last."""
        base, found = self._compacted(table, stream_id), {}
        for name in folders.subfolders(spark, base):
            number = int(name.partition("=")[2])
            versions = sorted(folders.subfolders(spark, f"{base}/{name}"), key=lambda v: int(v.partition("=")[2]))
            whole = [f"{base}/{name}/{v}" for v in versions if folders.exists(spark, f"{base}/{name}/{v}/_SUCCESS")]
            if whole:
                found[number] = whole
        return found

    def _loose(self, spark: SparkSession, table: str, stream_id: str | None) -> dict[int, int]:
        """Batches with a folder of their own, with its time. They win over the same batch in a range."""
        names = folders.subfolders(spark, self._batches(table, stream_id))
        ids = {name.removeprefix("batch_id="): at for name, at in names.items() if name.startswith("batch_id=")}
        return {int(batch): at for batch, at in ids.items() if batch != _NO_BATCH}

    def compact(
        self, spark: SparkSession, table: str, stream_id: str | None = None, before: int | None = None, width: int = RANGE_BATCHES
    ) -> int:
        """Merge batches with an id below ``before`` (all, if None) into ranges of ``width`` ids; how many.

        A range becomes few files, sorted by batch and key. Readers find a batch in its own folder first,
        then in its range, so results are the same before, during and after, and a batch that is replaced
        later goes into a folder again, until the next compaction. A run that fails leaves at most an
        incomplete version, which nobody reads. Give a ``before`` that the stream has passed, run one
        compaction of a table at a time, and keep ``width`` the same. The batch of rows without an id stays.
        """
        columns = {**self._stored_columns(table), "batch_id": "bigint"}
        loose = {b: at for b, at in self._loose(spark, table, stream_id).items() if before is None or b < before}
        versions = self._versions(spark, table, stream_id)
        key = [name for name in TABLES[table].key if name != "batch_id"]
        for number in sorted({batch // width for batch in loose}):
            own = sorted(batch for batch in loose if batch // width == number)
            paths = [self.batch_path(table, batch, stream_id) for batch in own]
            rows = self.reader(spark, columns).option("basePath", self._batches(table, stream_id)).load(paths)
            if older := versions.get(number):
                held = self.reader(spark, columns).load(older[-1])
                rows = rows.unionByName(held.filter(~F.col("batch_id").isin(own)))
            last = int(older[-1].rpartition("=")[2]) if older else 0
            into = f"{self._compacted(table, stream_id)}/range={number}/version={last + 1}"
            self.writer(rows.repartitionByRange("batch_id", *key).sortWithinPartitions("batch_id", *key), "overwrite").save(into)
            now = self._loose(spark, table, stream_id)
            for batch in own:
                # A batch replaced meanwhile keeps its folder, which wins over the range.
                if now.get(batch) == loose[batch]:
                    folders.delete(spark, self.batch_path(table, batch, stream_id))
            for path in older or ():
                folders.delete(spark, path)
        return len(loose)

    # --- reading -------------------------------------------------------------

    def _stored_columns(self, table: str) -> dict[str, str]:
        return {**TABLES[table].columns, **(_REJECT if table not in KEYLESS else {})}

    def _everything(self, spark: SparkSession, table: str, stream_id: str | None) -> DataFrame | None:
        """All stored rows of a table, rejects included, or None if nothing was ever written."""
        columns = self._stored_columns(table)
        if stream_id is not None:
            columns = {**columns, "batch_id": "bigint"}
        parts, base = [], self._batches(table, stream_id)
        while True:
            loose = self._loose(spark, table, stream_id).keys()
            batches = self.reader(spark, columns).load(base) if folders.exists(spark, base) else None
            versions = self._versions(spark, table, stream_id)
            # Else a compaction moved batches between the two listings.
            if loose == self._loose(spark, table, stream_id).keys():
                break
        if batches is not None:
            parts.append(batches)
        if versions:
            held = self.reader(spark, {**columns, "batch_id": "bigint"}).load([whole[-1] for whole in versions.values()])
            parts.append(held.filter(~F.col("batch_id").isin(sorted(loose))) if loose else held)
        appended = f"{self.path(table)}/appended"
        if stream_id is None and folders.exists(spark, appended):
            parts.append(self.reader(spark, columns).load(appended))
        return reduce(DataFrame.unionByName, [part.select(*columns) for part in parts]) if parts else None

    def read(self, spark: SparkSession, table: str, stream_id: str | None = None) -> DataFrame:
        """All batches, of one stream or of a table written without streams.

        A table that no batch has written yet is an empty one.
        """
        if table == "rejected_rows" and stream_id is None:
            return self._rejected(spark)
        columns = dict(TABLES[table].columns)
        if stream_id is not None:
            columns.setdefault("batch_id", "bigint")
        rows = self._everything(spark, table, stream_id)
        return self._empty(spark, columns) if rows is None else self._kept(rows, table).select(*columns)

    def appended(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of ``append`` as they came, those without a whole key included."""
        return self.reader(spark, TABLES[table].columns).load(f"{self.path(table)}/appended")

    def _kept(self, rows: DataFrame, table: str) -> DataFrame:
        return rows if table in KEYLESS else rows.filter("_reason IS NULL")

    def _rejected(self, spark: SparkSession) -> DataFrame:
        """The rejects of all tables written without streams, numbered where they are equal."""
        found = [self._everything(spark, "rejected_rows", None)]
        for table in (t for t in TABLES if t not in KEYLESS):
            rows = self._everything(spark, table, None)
            if rows is not None:
                batch = F.col("batch_id") if "batch_id" in rows.columns else F.lit(None).cast("bigint")
                refused = rows.filter("_reason IS NOT NULL")
                refused = refused.select(batch.alias("batch_id"), F.lit(table).alias("table_name"), F.col("_reason").alias("reason"), F.col("_payload").alias("payload"))
                found.append(numbered_copies(refused, ["batch_id"]))
        parts = [rows.select(*TABLES["rejected_rows"].columns) for rows in found if rows is not None]
        return reduce(DataFrame.unionByName, parts) if parts else self._empty(spark, TABLES["rejected_rows"].columns)

    def latest(self, spark: SparkSession, table: str, stream_id: str) -> DataFrame:
        """One row per key of the table, the last one written: what a keyed store would hold.

        Rows of equal key in one batch have no order of writing; the greatest in column order wins.
        """
        return newest_by_key(self.read(spark, table, stream_id), TABLES[table].key)

    def lookup(
        self, spark: SparkSession, table: str, batch_id: int, stream_id: str | None = None, width: int = RANGE_BATCHES
    ) -> DataFrame:
        """The rows of one batch, read from its folder, or from its range if it was compacted with ``width``.

        The other batches are not even listed. A batch that was never written has no rows.
        """
        columns = {**self._stored_columns(table), "batch_id": "bigint"}
        shown = list(TABLES[table].columns) + ["batch_id"] * (stream_id is not None and "batch_id" not in TABLES[table].columns)
        folder = self.batch_path(table, batch_id, stream_id)
        if folders.exists(spark, folder):
            rows = self.reader(spark, columns).option("basePath", folder.rsplit("/", 1)[0]).load(folder)
            return self._kept(rows, table).select(*shown)
        base = f"{self._compacted(table, stream_id)}/range={batch_id // width}"
        versions = sorted(folders.subfolders(spark, base), key=lambda v: int(v.partition("=")[2]))
        whole = [f"{base}/{v}" for v in versions if folders.exists(spark, f"{base}/{v}/_SUCCESS")]
        if not whole:
            return self._empty(spark, {name: columns[name] for name in shown})
        rows = self.reader(spark, columns).load(whole[-1]).filter(F.col("batch_id") == batch_id)
        return self._kept(rows, table).select(*shown)

    def reader(self, spark: SparkSession, columns: Mapping[str, str]) -> DataFrameReader:
        # Declared, not inferred: no footer is read up front and ids keep their types.
        return spark.read.format(self.fmt).options(**self.options).schema(_ddl(columns))

    def _empty(self, spark: SparkSession, columns: Mapping[str, str]) -> DataFrame:
        return spark.createDataFrame([], _ddl(columns))


def _ddl(columns: Mapping[str, str]) -> str:
    return ", ".join(f"`{name}` {dtype}" for name, dtype in columns.items())


class ConnectorStore:
    """Tables of an external store behind a Spark connector that overwrites rows of equal key.

    The keys make a retried batch replace its rows, so plain appends do. ``table_option`` is the
    connector's name for the table; ``stream_id`` is written as a column, which belongs in
    the tables' keys, unless ``write_stream_id`` is off. Owners of streams are not kept here: give each
    stream id to one checkpoint only. Reads are filters on the keys, which connectors push down.
    """

    def __init__(
        self,
        fmt: str,
        options: Mapping[str, str] | None = None,
        table_option: str = "table",
        write_stream_id: bool = True,
    ):
        self.fmt, self.options = fmt, dict(options or {})
        self.table_option, self.write_stream_id = table_option, write_stream_id

    def replace_batch(self, rows: DataFrame, table: str, stream_id: str, batch_id: int) -> None:
        if self.write_stream_id:
            rows = rows.withColumn("stream_id", F.lit(stream_id))
        (
            rows.write.format(self.fmt)
            .options(**self.options)
            .option(self.table_option, table)
            .mode("append")
            .save()
        )

    def read(self, spark: SparkSession, table: str, stream_id: str | None = None) -> DataFrame:
        """The table's columns, of one stream if it is given and written."""
        rows = spark.read.format(self.fmt).options(**self.options).option(self.table_option, table).load()
        if self.write_stream_id and stream_id is not None:
            rows = rows.filter(F.col("stream_id") == stream_id)
        return conform(rows, table)

    def lookup(self, spark: SparkSession, table: str, batch_id: int, stream_id: str | None = None) -> DataFrame:
        """The rows of one batch of a table that is keyed by batch."""
        if "batch_id" not in TABLES[table].key:
            raise ValueError(f"{table} is not keyed by batch in a store of one row per key")
        return self.read(spark, table, stream_id).filter(F.col("batch_id") == batch_id)

    def latest(self, spark: SparkSession, table: str, stream_id: str | None = None) -> DataFrame:
        """One row per key, which is what such a store holds."""
        return self.read(spark, table, stream_id)


def rejects(
    rejected: DataFrame, table: str, columns: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Rejected rows of one table in the shape of ``rejected_rows``, with only the batch columns in ``carry``."""
    payload = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return numbered_copies(rejected.select(*carry, F.lit(table).alias("table_name"), "reason", payload.alias("payload")), carry)


def numbered_copies(shaped: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Add ``copy``, which numbers rows that are equal in all, and ``row_hash``.

    So the key tells rows apart, and a batch that is done again has the same keys.
    """
    same = shaped.groupBy(*carry, "table_name", "reason", "payload").agg(F.count(F.lit(1)).alias("_n"))
    each = same.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).drop("_n")
    return each.withColumn("row_hash", F.sha2(F.concat_ws("\n", "reason", "payload"), 256))
