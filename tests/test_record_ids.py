"""Records that a batch run twice writes twice are read once."""

import datetime as dt

from pyspark.sql import functions as F

from entryflow.plans import jobs, raffle
from entryflow.sinks.topics import RECORD_ID, with_record_ids, write_topic
from entryflow.sources.topics import read_records_batch, read_records_stream
from entryflow.streaming.queries import fan_out

from conftest import record
from test_streaming import src, write_json

KV = "key string, value string"
ROWS = [("a", "1"), ("b", "2"), ("b", "2"), ("c", None), (None, "4")]


def ids(spark, rows, partitions, batch_id=7):
    df = spark.createDataFrame(rows, KV).repartition(partitions)
    return {(r.record_id): (r.key, r.value) for r in with_record_ids(df, "q", batch_id).collect()}


def test_ids_do_not_depend_on_partitions(spark):
    one = ids(spark, ROWS, 1)
    assert one == ids(spark, ROWS[::-1], 4) and len(one) == 5
    assert set(one) == {f"q:7:{i}" for i in range(5)} and not set(one) & set(ids(spark, ROWS, 2, 8))


def write_twice(spark, path, winners):
    """A batch whose second attempt sees other winners, and another batch."""
    sink = {"format": "json", "path": path}
    for batch_id, numbers, hits in ((0, (1, 2, 3), winners[:1]), (0, (1, 2, 3), winners), (1, (1, 4), winners)):
        batch = with_record_ids(spark.createDataFrame([record("20220915", n) for n in numbers], KV), "q", batch_id)
        dw = spark.createDataFrame([(dt.date(2022, 9, 15), n) for n in hits], "day date, winnernumber long")
        write_topic(raffle.flagged_to_records(raffle.flag_keys(batch, dw)), sink)


def test_read_once_in_batch_and_stream(spark, tmp_dir):
    path = f"{tmp_dir}/topic"
    write_twice(spark, path, [1, 3])
    write_topic(spark.createDataFrame([("x", "no id")] * 2, KV), {"format": "json", "path": path})
    want = ["20220915_1"] * 2 + ["20220915_2", "20220915_3", "20220915_4", "x", "x"]
    assert read_records_batch(spark, "json", path).count() == 10
    once = read_records_batch(spark, "json", path, once=True)
    assert once.columns == ["key", "value"] and sorted(r.key for r in once.collect()) == want
    seen = []
    stream = read_records_stream(spark, "json", path, {"maxFilesPerTrigger": "1"}, once="1 hour")
    fan_out(stream, [lambda b, i: seen.extend(r.key for r in b.collect())], f"{tmp_dir}/ck",
            "available_now").awaitTermination()
    assert sorted(seen) == want


def test_ids_leave_the_state(spark, tmp_dir):
    path = f"{tmp_dir}/topic"
    base = with_record_ids(spark.createDataFrame([record("20220915", n) for n in range(4)], KV), "q", 0)
    header = F.array(F.struct(F.lit(RECORD_ID).alias("key"), F.col(RECORD_ID).cast("binary").alias("value")))
    for hour in (0, 1, 8, 16):
        at = F.lit(f"2022-09-15 {hour:02d}:00:00").cast("timestamp")
        again = F.when(F.lit(hour == 1), F.col(RECORD_ID)).otherwise(F.concat(F.col(RECORD_ID), F.lit(f"-{hour}")))
        rows = base.withColumn(RECORD_ID, again if hour else F.col(RECORD_ID))
        rows.select("key", "value", header.alias("headers"), at.alias("timestamp")).coalesce(1) \
            .write.mode("append").json(path)
    counts = []
    stream = read_records_stream(spark, "json", path, {"maxFilesPerTrigger": "1"}, once="2 hours")
    q = fan_out(stream, [lambda b, i: counts.append(b.count())], f"{tmp_dir}/ck", "available_now")
    q.awaitTermination()
    assert sum(counts) == 12  # the batch of hour 1 repeats that of hour 0
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 4


def test_flagged_job_with_ids(spark, tmp_dir):
    write_json(f"{tmp_dir}/in", "a", [record("20220915", n) for n in (1, 2)] + [("odd", "x")])
    winners = spark.createDataFrame([(dt.date(2022, 9, 15), 2)], "day date, winnernumber long")
    for i in range(2):  # two deployments that share a topic folder write under their own ids
        jobs.run_flagged(spark, src(f"{tmp_dir}/in"), winners, f"{tmp_dir}/table",
                         {"format": "json", "path": f"{tmp_dir}/topic{i}"}, f"{tmp_dir}/ck{i}", "available_now",
                         as_of=None, record_ids=True).awaitTermination()
    written = [spark.read.json(f"{tmp_dir}/topic{i}") for i in range(2)]
    assert all({"headers", "timestamp"} < set(w.columns) for w in written)
    both = written[0].unionByName(written[1]).drop("batch_id")
    both.write.json(f"{tmp_dir}/all")
    both.write.mode("append").json(f"{tmp_dir}/all")
    assert read_records_batch(spark, "json", f"{tmp_dir}/all").count() == 8
    assert read_records_batch(spark, "json", f"{tmp_dir}/all", once=True).count() == 4
