"""Stored tables that batches are merged into where they lie.

A table is Parquet in buckets of the hash of its key, registered in the session's catalog at its
path. A join on the key then shuffles the batch only: the table's side has neither an
exchange nor a broadcast, however long its history is. Optionally the table is partitioned by an
expression over its rows; an updating merge rewrites only the partitions that it touches.

An update is staged first, in a folder inside the table that readers do not see: the new
contents of the touched partitions, and at last the list of these partitions. Until then the
table is as it was. A staged update that was not carried out, because the job died, is carried
out by ``recover`` (or by the next update), and as often as need be with the same result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tapewire.operators.columns import align
from tapewire.operators.upsert import new_rows, prepare_batch, upsert

BUCKETS = 32
_SPEC, _STAGED = "_keyed", "_update-"


class KeyedTable:
    """A table of unique keys at ``path``.

    ``partition``: name of the partition column and the expression that gives its value. The
    bucket count and the key are stored with the table; opening it with others is an error,
    opening it without a count takes the stored one.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        buckets: int | None = None,
        partition: tuple[str, Column] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.buckets, self.partition = list(keys), buckets, partition
        self.name = "keyed_" + hashlib.md5(self.path.encode()).hexdigest()
        self._check_spec()
        self._register()

    def _fs(self, path: str):
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _check_spec(self) -> None:
        spec = {"buckets": self.buckets or BUCKETS, "keys": self.keys, "partition": self._by()}
        files, at = self._fs(f"{self.path}/{_SPEC}")
        if not files.exists(at):
            self._refuse_other_files()
            one = self.spark.createDataFrame([(json.dumps(spec),)], "spec string")
            one.coalesce(1).write.mode("ignore").text(f"{self.path}/{_SPEC}")
        stored = json.loads(self.spark.read.text(f"{self.path}/{_SPEC}").first()["value"])
        if stored != {**spec, "buckets": self.buckets or stored["buckets"]}:
            raise ValueError(f"{self.path} is not stored as {spec}")
        self.buckets = stored["buckets"]

    def _refuse_other_files(self) -> None:
        files, at = self._fs(self.path)
        names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
        if any(not n.startswith(("_", ".")) for n in names):
            raise ValueError(f"{self.path} holds other files; append their rows to a new table")

    def _by(self) -> str | None:
        return self.partition[0] if self.partition else None

    def _register(self) -> None:
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema]
        by = ""
        if self.partition:
            plain = self.spark.createDataFrame([], self.schema).select(self.partition[1])
            fields.append(f"`{self._by()}` {plain.schema[0].dataType.simpleString()}")
            by = f"PARTITIONED BY (`{self._by()}`)"
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(fields)}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') {by} CLUSTERED BY ({keys}) "
            f"SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        self._refresh()

    def _refresh(self) -> None:
        if self.partition:
            self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)

    def read(self) -> DataFrame:
        """All rows, the partition column included."""
        return self.spark.table(self.name)

    def new_rows(self, batch: DataFrame, order: Sequence[Column]) -> DataFrame:
        """The prepared rows of ``batch`` whose keys are not stored.

        The table is read by its keys and stays where it is: the batch's keys are broadcast
        where they are few and else shuffled to the buckets. The batch is read twice, the
        second time against the keys that it shares with the table.
        """
        return new_rows(self.read(), batch, self.keys, order)

    def insert(self, batch: DataFrame, order: Sequence[Column]) -> int:
        """Insert-only merge; returns the number of rows added."""
        return self.append(self.new_rows(batch, order))

    def append(self, rows: DataFrame) -> int:
        """Add rows of keys that are not stored, in one file for each bucket and partition."""
        return self._write(self._placed(align(rows, self.schema)), overwrite=False)

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(*self.partition) if self.partition else rows

    def _write(self, rows: DataFrame, overwrite: bool) -> int:
        seen = Observation()
        dealt = rows.repartition(self.buckets, *self.keys)
        dealt = dealt.observe(seen, F.count(F.lit(1)).alias("rows"))
        dealt.write.insertInto(self.name, overwrite=overwrite)
        self._refresh()
        return seen.get["rows"]

    def update(self, batch: DataFrame, order: Sequence[Column]) -> dict[str, int]:
        """Updating merge: stored rows take the batch's values, nulls included, and keep columns
        that the batch lacks; other rows of the batch are added.

        Rewrites the partitions that hold or get a changed row, and no other file. Returns
        numbers of partitions rewritten, of rows written there and of rows added elsewhere.
        """
        if not self.partition:
            raise ValueError("only a partitioned table is updated in place")
        unknown = [c for c in batch.columns if c not in self.schema.fieldNames()]
        if unknown:
            raise ValueError(f"columns not in the table: {unknown}")
        self.recover()
        by, stage = self._by(), f"{self.path}/{_STAGED}{uuid.uuid4().hex}"
        try:
            self._stage(batch, order, stage)
        except Exception:
            self._delete(stage)
            raise
        return self._carry_out(stage, by)

    def _saved(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _stage(self, batch: DataFrame, order: Sequence[Column], stage: str) -> None:
        by = self._by()
        ready = self._saved(prepare_batch(batch, self.keys, order), f"{stage}/batch")
        stored = self.read()
        hits = self._saved(
            stored.join(ready.select(*self.keys), self.keys, "left_semi"), f"{stage}/hits"
        )
        merged = upsert(hits.drop(by), ready, self.keys, order, "update")
        was = hits.select(*self.keys, F.col(by).alias("_from"), F.lit(True).alias("_held"))
        changed = self._placed(merged).join(was, self.keys, "left")
        changed = self._saved(changed, f"{stage}/changed")
        moved = changed.where("_held")
        touched = moved.select(F.col("_from").alias(by)).union(moved.select(by)).distinct()
        # At most as many values as the table has partitions.
        values = [r[0] for r in touched.collect()]
        inside = self._within(values)
        kept = stored.where(inside).join(ready.select(*self.keys), self.keys, "left_anti")
        new = changed.select(*stored.columns)
        self._saved(kept.select(*stored.columns).union(new.where(inside)), f"{stage}/rows")
        self._saved(new.where(~inside), f"{stage}/added")
        self._saved(touched, f"{stage}/touched")

    def _within(self, values: Sequence) -> Column:
        """Whether a row lies in one of these partitions, of which one may be null."""
        column = F.col(self._by())
        known = F.coalesce(column.isin([v for v in values if v is not None]), F.lit(False))
        return known | column.isNull() if None in values else known

    def _carry_out(self, stage: str, by: str) -> dict[str, int]:
        """Put a staged update in place. Doing it again changes nothing."""
        stored = self.read().schema
        rows = self.spark.read.schema(stored).parquet(f"{stage}/rows")
        added = self.spark.read.schema(stored).parquet(f"{stage}/added")
        touched = self.spark.read.schema(T.StructType([stored[by]])).parquet(f"{stage}/touched")
        values = {r[0] for r in touched.collect()}
        written = self._write(rows, overwrite=True) if values else 0
        # A partition that all rows left is not overwritten by anything.
        left = {r[0] for r in rows.select(by).distinct().collect()}
        for value in values - left:
            self._drop_partition(by, value)
        more = self.insert(added.drop(by), [F.lit(1)])
        self._delete(stage)
        return {"partitions": len(values), "rows_rewritten": written, "rows_added": more}

    def _drop_partition(self, by: str, value) -> None:
        text = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        self._delete(f"{self.path}/{by}={text}")
        literal = "null" if value is None else f"'{value}'"
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (`{by}` = {literal})")
        self.spark.catalog.refreshTable(self.name)

    def recover(self) -> int:
        """Carry out staged updates that are complete and delete others; returns the former."""
        files, at = self._fs(self.path)
        found = [str(s.getPath()) for s in files.listStatus(at)]
        done = 0
        for stage in (p for p in found if p.rsplit("/", 1)[1].startswith(_STAGED)):
            marker, place = self._fs(f"{stage}/touched/_SUCCESS")
            if marker.exists(place):
                self._carry_out(stage, self._by())
                done += 1
            else:
                self._delete(stage)
        return done

    def _delete(self, path: str) -> None:
        files, at = self._fs(path)
        files.delete(at, True)
