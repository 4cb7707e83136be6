import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from goldweave.operators import (
    Windows,
    catch_up,
    collapse,
    due_windows,
    latest_in_window,
    window_maxima,
)
from goldweave.plans.item_load import instant

START = datetime(2024, 1, 1)
CONTROL = "sync_up_id string, start_time timestamp, end_time timestamp, sync_up_date timestamp"


def us(t):
    return int(t.replace(tzinfo=timezone.utc).timestamp()) * 1_000_000 + t.microsecond


def cut(t):
    return t.replace(microsecond=0)


def loop(start, end, sync, stride, now=None):
    """Windows one after the other."""
    hour = None
    if now is not None:
        hour = cut(now + timedelta(minutes=30)).replace(minute=0, second=0)
    start = start if start is not None else hour - stride
    end = end if end is not None else hour
    out = []
    while cut(end) + stride <= cut(sync) - stride:
        out.append((start, end))
        start, end = end, cut(end) + stride
    return out, start, end


def plan(spark, start, end, sync, per_day, now=START):
    control = spark.createDataFrame([("s", start, end, sync)], CONTROL)
    return due_windows(control, F.lit(per_day), instant(now))


@pytest.mark.parametrize(
    "start,end,hours",
    [
        (START, START + timedelta(hours=6), 40),
        (START, START + timedelta(hours=6, microseconds=250), 40),
        (START, START + timedelta(hours=13), 43),
        (START + timedelta(hours=5), START + timedelta(hours=6), 18),
        (START, START + timedelta(hours=6), 17),
        (None, None, 60),
    ],
)
def test_due_windows_and_tags(spark, start, end, hours):
    now = START + timedelta(hours=6, minutes=40)
    sync, stride = START + timedelta(hours=hours), timedelta(hours=6)
    expected, next_start, next_end = loop(start, end, sync, stride, now)
    planned = plan(spark, start, end, sync, 4, now)
    row = planned.first()
    assert row.due == len(expected)
    if expected:
        assert (row.next_start, row.next_end) == (next_start, next_end)
    else:
        assert (row.next_start, row.next_end) == (start, end)
    w = Windows.of(planned)
    rng = random.Random(hours)
    times = [START + timedelta(minutes=rng.randrange(-120, 4000)) for _ in range(60)]
    times += [t for s, e in expected for t in (s, e, e + timedelta(microseconds=1), e - timedelta(microseconds=1))]
    rows = spark.createDataFrame([(t,) for t in set(times)], "at timestamp")
    got = sorted((r.window, r.at) for r in w.tag(rows, "at").collect())
    assert got == sorted(
        (i, t) for t in set(times) for i, (s, e) in enumerate(expected) if s <= t <= e
    )


@pytest.mark.parametrize("seconds,due", [(0, 1), (-1, 0)])
def test_lag_rule(spark, seconds, due):
    end, stride = START + timedelta(hours=6), timedelta(hours=6)
    sync = end + 2 * stride + timedelta(seconds=seconds)
    assert plan(spark, START, end, sync, 4).first().due == due


def test_stride_is_whole_seconds(spark):
    assert plan(spark, START, START, START, 7).first().stride_s == round(86400 / 7)


@pytest.mark.parametrize("sync,per_day", [(None, 4), (START, 0), (START, None), (START, -1)])
def test_guards(spark, sync, per_day):
    with pytest.raises(Exception, match="frequency|sync time"):
        plan(spark, START, START, sync, F.lit(per_day).cast("double")).collect()


MESSAGES = "item string, seq_num long, sys_creation_date timestamp, text string"


def test_tie_outside_the_window(spark):
    inside, outside = START, START + timedelta(days=9)
    log = spark.createDataFrame(
        [("A", 5, inside, "in"), ("A", 5, outside, "out"), ("A", 9, outside, "later"),
         ("B", 1, outside, "none"), (None, 1, inside, "null")],
        MESSAGES,
    )
    end = START + timedelta(hours=1)
    got = latest_in_window(log, instant(START), instant(end))
    assert sorted(r.text for r in got.collect()) == ["in", "out"]


@pytest.mark.parametrize("at,taken", [(0, True), (60, True), (61, False), (-1, False)])
def test_both_ends_belong_to_the_window(spark, at, taken):
    log = spark.createDataFrame([("A", 1, START + timedelta(minutes=at), "x")], MESSAGES)
    got = latest_in_window(log, instant(START), instant(START + timedelta(hours=1)))
    assert got.count() == taken


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_equals_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["A", "B", "C", None]), rng.choice([None, 1, 2, 3]),
         START + timedelta(hours=rng.randrange(0, 60)), rng.choice("pqrs"))
        for _ in range(40)
    ]
    windows, _, _ = loop(START, START + timedelta(hours=6), START + timedelta(hours=66), timedelta(hours=6))
    first, last, times = {}, {}, 0
    for s, e in windows:
        best = {}
        for item, seq, at, _ in rows:
            if item and seq is not None and s <= at <= e:
                best[item] = max(best.get(item, 0), seq)
        for item, seq, _, text in sorted(rows, key=lambda r: r[3]):
            if item and seq is not None and best.get(item) == seq:
                first.setdefault(item, text)
                last[item] = text
                times += 1
    w = Windows(us(START), us(START + timedelta(hours=6)), 21600, len(windows))
    log = spark.createDataFrame(rows, MESSAGES)
    won = catch_up(log, window_maxima(log, w))
    got = collapse(won, ["item"], insert_only=["first_window", "text"])
    assert {r.item: r.text for r in got.collect()} == first
    got = collapse(won, ["item"], updated=["last_window", "text"])
    assert {r.item: r.text for r in got.collect()} == last
    assert (won.agg(F.sum("times")).first()[0] or 0) == times
