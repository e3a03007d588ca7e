import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tapewire.operators import history
from tapewire.operators.as_of import last_before
from tests.conftest import rows

START = dt.date(2015, 1, 1)


def day(n):
    return START + dt.timedelta(days=n)


@pytest.mark.parametrize("lookback", [1, 3, 40])
def test_as_of_equals_a_plain_search(spark, lookback):
    rng = random.Random(lookback)
    history_rows = [(s, day(n), rng.random()) for s in ("a", "b", "hot")
                    for n in range(0, 900) if rng.random() < 0.3] + [(None, day(1), 1.0), ("a", None, 2.0)]
    asked = [(s, day(rng.randrange(-5, 1000))) for s in ("a", "b", "c", "hot") for _ in range(120)]
    asked += [("hot", day(50))] * 200 + [(None, day(3)), ("a", None)]
    wanted = spark.createDataFrame(asked, "k string, d date")
    known = spark.createDataFrame(history_rows, "k string, at date, v double")
    got = sorted(rows(last_before(wanted, known, "k", "d", "at", lookback)))
    want = []
    for k, d in {(k, d) for k, d in asked if k and d}:
        own = [(at, v) for s, at, v in history_rows
               if s == k and at and d - dt.timedelta(days=lookback) < at <= d]
        if own:
            want.append((k, d, *max(own)))
    assert got == sorted(want)
    text = last_before(wanted, known, "k", "d", "at", lookback)._jdf.queryExecution().toString()
    assert "Join" not in text.split("Physical Plan")[1]


def daily(spark, n, keys=("x", "y"), step=3):
    rng = random.Random(n)
    data = [(k, day(i * step), rng.randint(1, 9), float(rng.randint(-9, 9))) for k in keys for i in range(n)]
    return data, spark.createDataFrame(data, "key string, day date, n long, total double")


def plain_decay(data, key, last, half_life):
    own = [(0.5 ** ((last - d).days / half_life), n, t) for k, d, n, t in data if k == key and d <= last]
    return sum(f * n for f, n, _ in own), sum(f * t for f, _, t in own)


@pytest.mark.parametrize("half_life", [0.5, 7.0])
def test_decayed_series_over_many_slices(spark, half_life):
    """A half-life of half a day cuts ten years into slices of 256 days."""
    data, table = daily(spark, 1200)
    got = rows(history.decayed_series(table, ["key"], half_life).orderBy("key", "day"))
    assert len(got) == len(data)
    for key, last, _, weight, score in got[::37] + got[-3:]:
        w, t = plain_decay(data, key, last, half_life)
        assert math.isclose(weight, w, rel_tol=1e-9)
        assert math.isclose(score, t / w, rel_tol=1e-9, abs_tol=1e-12)


def test_states_of_days_one_by_one_are_the_state_of_all(spark):
    data, table = daily(spark, 40)
    as_of = F.lit(day(200)).cast("date")
    whole = history.decayed_state(table, ["key"], as_of, 7.0)
    state = None
    for part in range(4):
        low, high = day(part * 40), day(part * 40 + 40)
        some = table.where((F.col("day") >= F.lit(low)) & (F.col("day") < F.lit(high)))
        end = F.lit(high).cast("date")
        new = history.decayed_state(some, ["key"], end, 7.0)
        state = new if state is None else history.merged_states([state, new], ["key"], end, 7.0)
    moved = sorted(rows(history.merged_states([state], ["key"], as_of, 7.0)))
    for a, b in zip(moved, sorted(rows(whole)), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9)
        assert math.isclose(a[3], b[3], rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(moved[0][2], plain_decay(data, "x", day(200), 7.0)[0], rel_tol=1e-9)


def test_rolling_rates_of_a_hot_key(spark):
    rng = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    data = [("hot" if i % 10 else "cold", start + dt.timedelta(seconds=rng.randrange(40_000)), i,
             rng.choice([True, False, None])) for i in range(3000)]
    table = spark.createDataFrame(data, "k string, ts timestamp_ntz, id long, hit boolean")
    out = history.rolling_rates(table, "k", "ts", "id", "hit", (5, 60), block=60)
    got = {r.id: r for r in out.collect()}
    assert len(got) == len(data)
    for key in ("hot", "cold"):
        own = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        for at, (_, _, i, _) in enumerate(own):
            assert got[i].position == at
            for frame in (5, 60):
                known = [r[3] for r in own[max(0, at - frame + 1) : at + 1] if r[3] is not None]
                want = sum(known) / len(known) if known else None
                value = got[i][f"rate_{frame}"]
                assert value == want or math.isclose(value, want, rel_tol=1e-12)
    # No window spans a key: the longest holds one block and the rows before it.
    with pytest.raises(ValueError, match="frame"):
        history.rolling_rates(table, "k", "ts", "id", "hit", (100,), block=60)


def test_correlation_of_odd_series(spark):
    days = [day(i) for i in range(30)]
    left = [("moved", d, float(i % 7)) for i, d in enumerate(days)]
    left += [("flat", d, 1.0) for d in days] + [("nan", d, float("nan")) for d in days]
    left += [("short", d, float(i)) for i, d in enumerate(days[:2])]
    right = [(k, day(i + 2), float(i % 7) * 2 + 1) for k in ("moved", "flat", "nan", "short") for i in range(30)]
    right += [("moved", day(100), float("inf"))]
    a = spark.createDataFrame(left, "k string, d date, x double")
    b = spark.createDataFrame(right, "k string, d date, y double")
    got = {(r.k, r.lag): r for r in history.lagged_correlation(a, b, "k", "d", "x", "y", [0, 2]).collect()}
    assert got["moved", 2].n == 30 and math.isclose(got["moved", 2].r, 1.0)
    assert abs(got["moved", 0].r) < 0.9 and got["moved", 0].t is not None
    assert got["flat", 2].r is None and got["short", 2].r is None
    assert not [k for k in got if k[0] == "nan"]


def test_slopes_across_years(spark):
    data = [("k", day(i), float(i * i % 50), None if i % 11 == 0 else 2.0 * i) for i in range(0, 800, 2)]
    table = spark.createDataFrame(data, "k string, d date, a double, b double")
    got = {r.d: r for r in history.slopes(table, "k", "d", ["a", "b"], [9, 30]).collect()}
    assert len(got) == len(data)
    for i in range(360, 380, 2):
        own = [(j, data[j // 2][2]) for j in range(0, 800, 2) if i - 9 < j <= i]
        mx = sum(x for x, _ in own) / len(own)
        my = sum(y for _, y in own) / len(own)
        want = sum((x - mx) * (y - my) for x, y in own) / sum((x - mx) ** 2 for x, _ in own)
        assert math.isclose(got[day(i)].slope_a_9, want, rel_tol=1e-6, abs_tol=1e-9)
        assert math.isclose(got[day(i)].slope_b_30, 2.0, rel_tol=1e-9)
    assert got[day(0)].slope_a_9 is None


def test_change_points_equal_a_loop(spark):
    rng = random.Random(2)
    values = [rng.gauss(0 if i < 60 else 3, 1) for i in range(120)]
    values[7] = float("nan")
    data = [("k", day(i), v) for i, v in enumerate(values)] + [("flat", day(i), 1.0) for i in range(9)]
    table = spark.createDataFrame(data, "k string, d date, v double")
    got = rows(history.change_points(table, "k", "d", "v", 0.5, 4.0).where("k = 'k'").orderBy("d"))
    known = [v for v in values if v == v]
    mean = sum(known) / len(known)
    dev = math.sqrt(sum((v - mean) ** 2 for v in known) / len(known))
    rise = fall = 0.0
    was = False
    for v, row in zip(values, got, strict=True):
        if v == v:
            rise, fall = max(0, rise + (v - mean) / dev - 0.5), max(0, fall - (v - mean) / dev - 0.5)
        assert math.isclose(row[3], rise, abs_tol=1e-9) and math.isclose(row[4], fall, abs_tol=1e-9)
        above = rise > 4 or fall > 4
        assert row[5] == (above and not was)
        was = above
    assert sum(r[5] for r in got) >= 1
    flat = rows(history.change_points(table, "k", "d", "v", 0.5, 4.0).where("k = 'flat'"))
    assert {r[3:] for r in flat} == {(0.0, 0.0, False)}
