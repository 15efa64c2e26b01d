"""State across micro-batches: cogroup counts, the guard against repeated keys, metrics."""

import datetime as dt
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from entryflow.operators.matching import cogroup_summary
from entryflow.plans import jobs, raffle
from entryflow.sinks.commits import commit_rows, read_table
from entryflow.sources.topics import read_records_stream
from entryflow.streaming import keyed, metrics
from entryflow.streaming.queries import fan_out

from conftest import promotion_rows, record
from test_streaming import PROMO_SCHEMA, src, write_json

KV = "key string, value string"


def feed(path, *batches):
    """A file, that is a micro-batch, per list of records; read in the order of their times."""
    n = len(os.listdir(path)) if os.path.isdir(path) else 0
    for i, rows in enumerate(batches):
        write_json(path, f"f{n + i:03d}", rows)
        at = 1_700_000_000 + n + i
        os.utime(f"{path}/f{n + i:03d}.json", (at, at))


def records(numbers, day="20220915"):
    return [record(day, n) for n in numbers]


# -- cogroup ------------------------------------------------------------------

def test_cogroup_counts_over_micro_batches_and_a_restart(spark, tmp_dir):
    promos = spark.createDataFrame([(dt.date(2022, 9, 15), n) for n in (1, 2, 2, 50)], "day date, winnernumber long")
    keys = raffle.promotion_keys(promos)
    batches = [records((1, 2, 3)), records((1, 1, 4)), records((2,)), records((5, 1)), [(None, "x"), (None, "y")],
               records((3, 3))]
    feed(f"{tmp_dir}/in", *batches[:4])
    args = (spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/counts", f"{tmp_dir}/ck", "available_now")
    jobs.run_cogroup(*args).awaitTermination()
    feed(f"{tmp_dir}/in", *batches[4:])
    q = jobs.run_cogroup(*args)  # a restart goes on with the state
    q.awaitTermination()
    assert q.lastProgress["batchId"] == 5
    changes = spark.read.parquet(f"{tmp_dir}/counts")
    got = keyed.cogroup_view(changes, keys, "key", left_name="entries", right_name="promotions")
    everything = spark.createDataFrame([r for b in batches for r in b], KV)
    want = cogroup_summary(everything.select("key"), keys.select("key"), "key", left_name="entries",
                           right_name="promotions")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # a row per key and batch that touched it, not per record
    assert changes.count() == sum(len({k for k, _ in b}) for b in batches)
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 6


def test_counts_of_closed_days_leave_the_state(spark, tmp_dir):
    schema = "key string, day timestamp, v long"
    inp = f"{tmp_dir}/in"
    for i, day in enumerate(("2022-09-01", "2022-09-02", "2022-09-20", "2022-09-21")):
        spark.createDataFrame([(f"k{n}", dt.datetime.fromisoformat(day), n + i) for n in range(5)], schema) \
            .coalesce(1).write.json(f"{inp}/b{i}")
        for f in os.listdir(f"{inp}/b{i}"):
            os.utime(f"{inp}/b{i}/{f}", (1_700_000_000 + i,) * 2)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{inp}/*")
    q = keyed.count_stream(stream, "key", f"{tmp_dir}/out", f"{tmp_dir}/ck", value="v", trigger="available_now",
                           event_time="day", delay="2 days")
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) <= 15
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 10  # two open days
    got = keyed.latest_counts(spark.read.parquet(f"{tmp_dir}/out"), "key", value="v", event_time="day")
    assert {(r.key, r.n_left, r.only_left) for r in got.collect()} == {(f"k{n}", 4, n) for n in range(5)}


# -- repeated keys --------------------------------------------------------------

def flagged(spark, tmp_dir, **more):
    winners = spark.createDataFrame([(dt.date(2022, 9, 15), 3)], "day date, winnernumber long")
    return jobs.run_flagged(spark, src(f"{tmp_dir}/in"), winners, f"{tmp_dir}/table",
                            {"format": "json", "path": f"{tmp_dir}/topic"}, f"{tmp_dir}/ck", trigger="available_now",
                            as_of=None, entries_unique=True, **more)


def test_repeats_go_to_the_dead_letters(spark, tmp_dir):
    first, other = record("20220915", 1), record("20220915", 1, name="Someone Else")
    feed(f"{tmp_dir}/in", [first, record("20220915", 2), ("odd", "not json"), (None, "a"), (None, "a")],
         [other, record("20220915", 3), ("odd2", "x")], [record("20220915", 4)] * 3 + [first])
    flagged(spark, tmp_dir, dead_letters=f"{tmp_dir}/dead").awaitTermination()
    feed(f"{tmp_dir}/in", records((2, 5)))  # after a restart, too
    flagged(spark, tmp_dir, dead_letters=f"{tmp_dir}/dead").awaitTermination()
    table = spark.read.parquet(f"{tmp_dir}/table").collect()
    assert sorted(r.participationnumber for r in table if r.email) == [1, 2, 3, 4, 5]
    assert [r.name for r in table if r.participationnumber == 1] == ["Test Person"]
    assert [r.participationnumber for r in table if r.winner] == [3]
    dead = sorted((r.key or "", r.value) for r in spark.read.parquet(f"{tmp_dir}/dead").collect())
    repeats = [other, first, *[record("20220915", 4)] * 2, record("20220915", 2)]
    assert dead == sorted([("", "a"), ("", "a"), ("odd", "not json"), ("odd2", "x"), *repeats])
    assert spark.read.json(f"{tmp_dir}/topic").count() == 5


def test_a_repeat_in_a_later_micro_batch_fails_the_job(spark, tmp_dir):
    feed(f"{tmp_dir}/in", records((1, 2)), records((3,)), records((2,)))
    with pytest.raises(Exception, match="duplicate rows for key 20220915_2"):
        flagged(spark, tmp_dir).awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/table").count() == 3


def test_within_a_batch_the_split_does_not_depend_on_order(spark):
    rows = [("k", "b", False), ("k", "a", False), ("k", "a", False), ("s", "z", True), (None, "n", False)] * 2
    want_good = [("k", "a"), (None, "n"), (None, "n")]
    for partitions in (1, 5):
        batch = spark.createDataFrame(rows, "key string, value string, seen boolean").repartition(partitions)
        good, again = (sorted(map(tuple, d.collect()), key=str) for d in keyed.split_repeats(batch))
        assert good == sorted(want_good, key=str)
        assert again == sorted([("k", "a")] * 3 + [("k", "b")] * 2 + [("s", "z")] * 2, key=str)


def test_state_of_past_days_is_gone(spark, tmp_dir):
    days = ["20220901", "20220902", "20220920", "20220921", "20220922"]
    future = ("99990101_7", "v")
    feed(f"{tmp_dir}/in", *[records(range(4), d) + [future] for d in days])
    seen = []
    kv = keyed.mark_seen(read_records_stream(spark, "json", f"{tmp_dir}/in", {"maxFilesPerTrigger": "1"}), delay="1 day")
    q = fan_out(kv, [lambda b, i: seen.extend(r.seen for r in b.collect())], f"{tmp_dir}/ck", "available_now")
    q.awaitTermination()
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    # a state per day and bucket; four keys a day are in four buckets at most
    assert max(totals) <= 16 and totals[-1] <= 12 and not any(seen)
    assert len(seen) == 4 * len(days) + len(days)  # a day to come closes none


def test_every_key_of_a_large_batch_is_remembered(spark, tmp_dir):
    kv = spark.range(3000).select(F.concat(F.lit("20220915_"), "id").alias("key"), F.lit("v").alias("value"))
    seen = []
    for i in range(2):
        kv.write.mode("append").parquet(f"{tmp_dir}/in")
        stream = keyed.mark_seen(read_records_stream(spark, "parquet", f"{tmp_dir}/in", {"maxFilesPerTrigger": "100"}))
        fan_out(stream, [lambda b, i: seen.append({r.seen: r.n for r in b.groupBy("seen").agg(
            F.count(F.lit(1)).alias("n")).collect()})], f"{tmp_dir}/ck", "available_now").awaitTermination()
    assert [s for s in seen if s] == [{False: 3000}, {True: 3000}]  # a batch without data closes days


def test_days_of_keys(spark):
    keys = ["20220915_1", "20221315_1", "x", None, "2022091_1", "99990101_2"]
    got = [r.d for r in spark.createDataFrame([(k,) for k in keys], "key string").select(
        keyed.entry_day().alias("d")).collect()]
    assert got[0] == dt.datetime(2022, 9, 15) and got[1:] == [None] * 5


# -- metrics ------------------------------------------------------------------

def table_of(spark, path):
    return {(r.job, r.batch_id): {k: v for k, v in r.asDict().items() if "." in k}
            for r in metrics.metrics_by_batch(spark, path).collect()}


def wait_for(check, seconds=20):
    until = time.time() + seconds
    while not check() and time.time() < until:
        time.sleep(0.2)
    return check()


def test_metrics_of_entries(spark, tmp_dir):
    feed(f"{tmp_dir}/in", records((1, 2)) + [("bad", "x")], records((3,)))
    for i, dead in enumerate((None, f"{tmp_dir}/dead")):
        jobs.run_entries(spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/t", f"{tmp_dir}/ck{i}", "available_now",
                         dead_letters=dead, metrics_to=f"{tmp_dir}/m{i}").awaitTermination()
        assert table_of(spark, f"{tmp_dir}/m{i}") == {("entries", 0): {"entries.records": 3},
                                                      ("entries", 1): {"entries.records": 1}}


@pytest.mark.parametrize("refresh", ["none", "batch"])
def test_metrics_of_winners(spark, tmp_dir, refresh):
    feed(f"{tmp_dir}/in", records((5, 13, 14)), records((1, 55)))
    promos = spark.createDataFrame(promotion_rows(), PROMO_SCHEMA)
    jobs.run_winners(spark, src(f"{tmp_dir}/in"), promos, f"{tmp_dir}/t", f"{tmp_dir}/ck", "available_now", refresh,
                     metrics_to=f"{tmp_dir}/m").awaitTermination()
    want = {("winners", 0): {"entries.records": 3, "promotions.records": 15, "winners.matches": 2, "winners.promotions": 2},
            ("winners", 1): {"entries.records": 2, "promotions.records": 15, "winners.matches": 1, "winners.promotions": 1}}
    assert wait_for(lambda: os.path.isdir(f"{tmp_dir}/m") and len(table_of(spark, f"{tmp_dir}/m")) == 2)
    assert table_of(spark, f"{tmp_dir}/m") == want


def test_metrics_of_flagged_entries_and_of_a_run_without_promotions(spark, tmp_dir):
    feed(f"{tmp_dir}/in", records((3, 4)), records((5,)))
    flagged(spark, tmp_dir, metrics_to=f"{tmp_dir}/m").awaitTermination()
    got = table_of(spark, f"{tmp_dir}/m")
    assert got[("flagged", 0)] == {"entries.records": 2, "promotions.records": 1, "winners.matches": 1}
    assert got[("flagged", 1)] == {"entries.records": 1, "promotions.records": 1, "winners.matches": 0}
    none = spark.createDataFrame([], PROMO_SCHEMA)
    jobs.run_winners(spark, src(f"{tmp_dir}/in"), none, f"{tmp_dir}/t", f"{tmp_dir}/ck2", "available_now", "batch",
                     metrics_to=f"{tmp_dir}/m2").awaitTermination()
    assert table_of(spark, f"{tmp_dir}/m2")[("winners", 0)] == {
        "entries.records": 2, "promotions.records": 0, "winners.matches": 0, "winners.promotions": 0}


def test_no_payload_in_metrics(spark, tmp_dir):
    feed(f"{tmp_dir}/in", records((1,)))
    jobs.run_entries(spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/t", f"{tmp_dir}/ck", "available_now",
                     metrics_to=f"{tmp_dir}/m").awaitTermination()
    rows = read_table(spark, f"{tmp_dir}/m").collect()
    assert rows and not any("t@x.org" in str(r) or "Test Person" in str(r) for r in rows)


def test_counts_of_a_batch_that_an_earlier_attempt_wrote(spark, tmp_dir):
    feed(f"{tmp_dir}/in", records((1, 2)))
    taps = metrics.Taps("j", f"{tmp_dir}/m")

    def sink(batch, batch_id):
        rows = taps.on(batch, "entries", records=F.count(F.lit(1)))
        return commit_rows(rows, f"{tmp_dir}/t", "w", 0)

    stream = read_records_stream(spark, "json", f"{tmp_dir}/in")
    for ck in ("a", "b"):  # the second finds its commit made
        fan_out(stream, [sink], f"{tmp_dir}/{ck}", "available_now", after=taps.commit).awaitTermination()
    got = read_table(spark, f"{tmp_dir}/m").collect()
    assert [(r.metric, r.value) for r in got] == [("entries.records", 2)] * 2


def test_progress_log(spark, tmp_dir):
    feed(f"{tmp_dir}/in", records((1, 2)), records((3,)))
    log = metrics.ProgressLog(spark, f"{tmp_dir}/p")
    spark.streams.addListener(log)
    try:
        jobs.run_entries(spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/t", f"{tmp_dir}/ck", "available_now").awaitTermination()
        assert wait_for(lambda: os.path.isdir(f"{tmp_dir}/p") and read_table(
            spark, f"{tmp_dir}/p", schema=metrics.PROGRESS_TABLE).count() == 2)
    finally:
        spark.streams.removeListener(log)
    rows = read_table(spark, f"{tmp_dir}/p").orderBy("batch_id").collect()
    assert [r.input_rows for r in rows] == [2, 1] and rows[0].state_rows == 0
    assert json.loads(rows[0].observed) == {"entries": {"records": 2}}
