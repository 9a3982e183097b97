import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from featflow.operators import window_state as ws
from featflow.operators.windows import window_mean_count
from featflow.sources import store

LENGTH, SLIDE = "1 hour", "15 minutes"


def _rows(df):
    return sorted((repr(r[0]), str(r[1]), None if r[2] is None else round(r[2], 9), r[3])
                  for r in df.collect())


def _name():
    return f"window_state_test.t_{uuid.uuid4().hex[:10]}"


@pytest.fixture(scope="module")
def data(spark):
    at = dt.datetime(2024, 1, 31, 20, 0)
    rows = [(i % 3 if i % 11 else None, at + dt.timedelta(minutes=7 * i),
             None if i % 5 == 0 else i * 0.25, i) for i in range(90)]
    rows.append((1, None, 1.0, 90))
    return spark.createDataFrame(rows, "zone int, at timestamp_ntz, fare double, i int")


def test_batches_add_up_in_any_order_and_again(spark, data):
    whole = _rows(window_mean_count(data, "zone", "at", "fare", LENGTH, SLIDE))
    state, merged = _name(), _name()
    # Cut inside windows and panes, over the end of a month.
    parts = [data.where(F.col("i").between(a, b)) for a, b in ((0, 13), (14, 14), (15, 48), (49, 90))]
    batches = [ws.batch_panes(p, "zone", "at", "fare", SLIDE, f"b/{j}")
               for j, p in enumerate(parts)]
    ws.create_state(spark, state, batches[0])
    for j in (2, 0, 3, 1, 2):
        ws.add_batch(spark, state, batches[j])
    assert _rows(ws.windows(spark.table(state), LENGTH, SLIDE)) == whole
    assert spark.table(state).where("batch = 'b/2'").count() == batches[2].count()
    ws.compact(spark, state, merged)
    assert _rows(ws.windows(spark.table(merged), LENGTH, SLIDE)) == whole
    assert {r.batch for r in spark.table(merged).select("batch").collect()} == {"all"}
    for t in (state, merged):
        store.drop_table(spark, t)


def test_touched_windows(spark, data):
    state = _name()
    a = ws.batch_panes(data.where("i < 20"), "zone", "at", "fare", SLIDE, "a")
    b = ws.batch_panes(data.where("i >= 20"), "zone", "at", "fare", SLIDE, "b")
    ws.create_state(spark, state, a)
    ws.add_batch(spark, state, a)
    ws.add_batch(spark, state, b)
    table = spark.table(state)
    whole = set(_rows(ws.windows(table, LENGTH, SLIDE)))
    for batch, rows in (("a", "i < 20"), ("b", "i >= 20")):
        own = {r[:2] for r in _rows(window_mean_count(data.where(rows), "zone", "at", "fare",
                                                      LENGTH, SLIDE))}
        got = _rows(ws.touched_windows(table, batch, LENGTH, SLIDE))
        assert len(got) == len(set(got)) and set(got) <= whole
        assert {r[:2] for r in got} == own
    assert ws.touched_windows(table, "none", LENGTH, SLIDE).count() == 0
    with pytest.raises(ValueError):
        ws.windows(table, "1 hour", "25 minutes")
    store.drop_table(spark, state)


def test_a_batch_leaves_other_partitions_alone(spark, data):
    state = _name()
    first = ws.batch_panes(data, "zone", "at", "fare", SLIDE, "first")
    ws.create_state(spark, state, first)
    ws.add_batch(spark, state, first)
    files = set(spark.table(state).inputFiles())
    ws.add_batch(spark, state, ws.batch_panes(data, "zone", "at", "fare", SLIDE, "second"))
    assert files < set(spark.table(state).inputFiles())
    ws.add_batch(spark, state, ws.batch_panes(data.limit(0), "zone", "at", "fare", SLIDE, "empty"))
    assert spark.table(state).count() == 2 * first.count()
    store.drop_table(spark, state)
