import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from tapewire.operators.upsert import upsert
from tapewire.sinks.keyed import KeyedTable
from tests.conftest import rows

SCHEMA = (
    T.StructType().add("k", "string").add("v", "integer").add("day", "date").add("kept", "string")
)


def order():
    return [F.col("v").desc()]


def open_table(spark, path, by_day=True, buckets=4):
    partition = ("month", F.trunc("day", "month")) if by_day else None
    return KeyedTable(spark, str(path), SCHEMA, ["k"], buckets, partition)


def batch(spark, *values):
    return spark.createDataFrame(list(values), "k string, v int, day string").withColumn(
        "day", F.col("day").cast("date")
    )


def contents(table):
    return sorted(map(str, rows(table.read().select(*SCHEMA.fieldNames()))))


def files(path):
    """All data files with their times and sizes."""
    return {
        str(f): (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path).rglob("*.parquet")
    }


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture
def table(spark, tmp_path):
    out = open_table(spark, tmp_path / "t")
    start = batch(spark, ("a", 1, "2024-01-05"), ("b", 2, "2024-02-05"), ("c", 3, "2024-03-05"),
                  ("d", 4, None), ("e", 5, "2024-01-20"))
    assert out.insert(start.withColumn("kept", F.col("k")), order()) == 5
    return out


@pytest.mark.parametrize("by_day", [True, False])
def test_insert_only(spark, tmp_path, by_day):
    table = open_table(spark, tmp_path / "t", by_day)
    incoming = batch(spark, (" a ", 1, None), ("b", 1, "2024-01-01"), ("b", 2, "2024-02-01"), (None, 1, None))
    assert table.insert(incoming, order()) == 2
    assert table.insert(incoming, order()) == 0
    assert table.insert(batch(spark, ("a", 9, None), ("c", 1, None)), order()) == 1
    got = sorted((r.k, r.v) for r in table.read().collect())
    assert got == [("a", 1), ("b", 2), ("c", 1)]
    # Files are where any reader of the path finds them.
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    again = open_table(spark, tmp_path / "t", by_day)
    assert again.read().count() == 3
    with pytest.raises(ValueError, match="not stored as"):
        open_table(spark, tmp_path / "t", by_day, buckets=8)


def test_update_equals_the_merge_of_a_whole_copy(spark, table):
    incoming = batch(spark, ("a", 9, "2024-01-06"), ("c", 8, "2024-02-01"), ("d", 7, None),
                     ("f", 6, "2024-01-01"), ("g", 5, "2024-09-01"), ("g", 4, None), (None, 1, None))
    want = upsert(table.read().drop("month"), incoming, ["k"], order(), "update")
    want = sorted(map(str, rows(want.select(*SCHEMA.fieldNames()))))
    done = table.update(incoming, order())
    assert contents(table) == want
    # January, February (gets c), March (loses c) and the rows without a day; g is added.
    assert done == {"partitions": 4, "rows_rewritten": 6, "rows_added": 1}
    assert not Path(table.path, "month=2024-03-01").exists()
    assert table.update(incoming, order())["rows_added"] == 0
    assert contents(table) == want
    reopened = open_table(spark, table.path)
    assert contents(reopened) == want


def test_update_leaves_other_files_alone(spark, table):
    before = files(table.path)
    table.update(batch(spark, ("a", 10, "2024-01-07"), ("new", 1, "2024-05-01")), order())
    after = files(table.path)
    untouched = {f for f in before if "month=2024-01" not in f}
    assert untouched and all(after[f] == before[f] for f in untouched)
    assert not [f for f in before if "month=2024-01" in f and f in after]
    assert not list(Path(table.path).glob("_update-*"))


def test_update_of_nothing(spark, table):
    before = files(table.path)
    assert table.update(batch(spark), order()) == {"partitions": 0, "rows_rewritten": 0, "rows_added": 0}
    assert files(table.path) == before
    with pytest.raises(ValueError, match="extra"):
        table.update(batch(spark).withColumn("extra", F.lit(1)), order())


def test_failed_staging_leaves_the_table(spark, table):
    before, old = files(table.path), contents(table)
    bad = batch(spark, ("a", 9, "2024-01-06")).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        table.update(bad, order())
    assert files(table.path) == before and contents(table) == old
    assert not list(Path(table.path).glob("_update-*"))


def test_update_that_died_is_carried_out_later(spark, table, monkeypatch):
    incoming = batch(spark, ("a", 9, "2024-04-06"), ("x", 6, "2024-01-01"), ("y", 1, "2024-12-01"))
    old = contents(table)
    want = upsert(table.read().drop("month"), incoming, ["k"], order(), "update")
    want = sorted(map(str, rows(want.select(*SCHEMA.fieldNames()))))

    def died(*_):
        raise RuntimeError("lost")

    # Once before anything is written, once between rewriting and deleting.
    for step in ("_carry_out", "insert"):
        with monkeypatch.context() as patch:
            patch.setattr(KeyedTable, step, died)
            with pytest.raises(RuntimeError, match="lost"):
                table.update(incoming, order())
        if step == "_carry_out":
            assert contents(table) == old
        assert len(list(Path(table.path).glob("_update-*"))) == 1
    assert table.recover() == 1
    assert contents(table) == want
    assert table.recover() == 0 and not list(Path(table.path).glob("_update-*"))


def test_half_staged_updates_are_deleted(spark, table):
    spark.range(3).write.parquet(f"{table.path}/_update-x/rows")
    old = contents(table)
    assert table.recover() == 0 and contents(table) == old
    assert not list(Path(table.path).glob("_update-*"))


def test_buckets_are_those_of_the_stored_table(spark, tmp_path):
    assert KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"], 4).buckets == 4
    assert KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["k"]).buckets == 4
    spark.range(1).write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="other files"):
        KeyedTable(spark, str(tmp_path / "other"), SCHEMA, ["k"])


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_the_stored_side_is_not_shuffled(spark, tmp_path, threshold):
    """At a million keys: no exchange and no broadcast of the table, whatever the batch."""
    table = open_table(spark, tmp_path / "t")
    many = spark.range(1_000_000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 60).cast("int")).alias("day"),
        F.repeat(F.lit("text"), 20).alias("kept"),
    )
    assert table.append(many) == 1_000_000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        some = spark.range(999_990, 1_000_005).select(F.concat(F.lit("k"), "id").alias("k"))
        fresh = table.new_rows(some, [F.col("k")])
        text = plan(fresh)
        tree = text[: text.index("\n\n\n")]
        # The branch of the table: from its scan up to the join that takes the batch in.
        lines = tree.splitlines()
        scan = next(i for i, line in enumerate(lines)
                    if (m := re.search(r"Scan parquet \S*keyed_\w+ \((\d+)\)", line)))
        branch = lines[:scan][::-1]
        above = []
        for line in branch:
            above.append(line)
            if "Join" in line:
                break
        assert not [line for line in above if "Exchange" in line]
        assert "Batched: true" in text and re.search(r"ReadSchema: struct<k:string>", text)
        assert fresh.count() == 5
        assert table.insert(some, [F.col("k")]) == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
