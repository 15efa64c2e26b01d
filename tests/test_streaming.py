import json
import os

from pyspark.sql import functions as F

from entryflow.plans import jobs, raffle
from entryflow.sinks.tables import conform
from entryflow.schemas import FLAGGED_TABLE
from entryflow.streaming.queries import with_taps

from conftest import SAMPLE_RECORDS, promotion_rows, record

PROMO_SCHEMA = "day string, promotion string, participation_number long"


def write_json(path, name, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.json", "w") as fh:
        for k, v in rows:
            fh.write(json.dumps({"key": k, "value": v}) + "\n")


def src(path):
    return {"source": "json", "path": path, "options": {"maxFilesPerTrigger": "1"}}


def test_winners_stream_equals_batch_and_restarts(spark, tmp_dir):
    inp, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    first = SAMPLE_RECORDS + [record("20220915", n) for n in (5, 13)]
    write_json(inp, "a", first[:4])
    write_json(inp, "b", first[4:])
    promos = spark.createDataFrame(promotion_rows(), PROMO_SCHEMA)
    jobs.run_winners(spark, src(inp), promos, out, ck, trigger="available_now").awaitTermination()
    batch = raffle.winners(spark.createDataFrame(first, "key string, value string"), promos)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == \
        sorted(map(tuple, batch.collect()))
    # restart on the same checkpoint: nothing re-processed
    jobs.run_winners(spark, src(inp), promos, out, ck, trigger="available_now").awaitTermination()
    assert spark.read.parquet(out).count() == 2
    # a new file is picked up exactly once
    write_json(inp, "c", [record("20220915", 21)])
    jobs.run_winners(spark, src(inp), promos, out, ck, trigger="available_now").awaitTermination()
    jobs.run_winners(spark, src(inp), promos, out, ck, trigger="available_now").awaitTermination()
    assert sorted(r.participation_number for r in spark.read.parquet(out).collect()) == [5, 13, 21]


def test_winners_stream_refresh_per_batch(spark, tmp_dir):
    inp, out, ck, ptab = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", f"{tmp_dir}/promos"
    spark.createDataFrame(promotion_rows()[:1], PROMO_SCHEMA).write.parquet(ptab)
    write_json(inp, "a", [record("20220915", 5), record("20220915", 13)])
    reread = lambda: spark.read.parquet(ptab)
    jobs.run_winners(spark, src(inp), reread, out, ck, trigger="available_now",
                     refresh="batch").awaitTermination()
    assert [r.participation_number for r in spark.read.parquet(out).collect()] == [5]
    # promotions added while the job runs are seen by later batches
    spark.createDataFrame(promotion_rows()[1:2], PROMO_SCHEMA).write.mode("append").parquet(ptab)
    write_json(inp, "b", [record("20220915", 13)])
    jobs.run_winners(spark, src(inp), reread, out, ck, trigger="available_now",
                     refresh="batch").awaitTermination()
    assert sorted(r.participation_number for r in spark.read.parquet(out).collect()) == [5, 13]


def test_entries_stream_keeps_bad_rows(spark, tmp_dir):
    inp, out, ck = f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck"
    write_json(inp, "a", SAMPLE_RECORDS[:2] + [("bad", "not json")])
    jobs.run_entries(spark, src(inp), out, ck, trigger="available_now").awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 3 and sum(r.email is None for r in rows) == 1


def test_flagged_fan_out(spark, tmp_dir):
    import datetime as dt
    inp, ck = f"{tmp_dir}/in", f"{tmp_dir}/ck"
    write_json(inp, "a", SAMPLE_RECORDS[:3])
    write_json(inp, "b", SAMPLE_RECORDS[3:])
    winners = spark.createDataFrame([(dt.date(2022, 9, 15), 4104)], "day date, winnernumber long")
    q = jobs.run_flagged(spark, src(inp), winners, f"{tmp_dir}/table",
                         {"format": "json", "path": f"{tmp_dir}/topic"}, ck,
                         trigger="available_now", as_of=None)
    q.awaitTermination()
    table = spark.read.parquet(f"{tmp_dir}/table")
    assert table.count() == 6 and table.where("winner").count() == 1
    topic = spark.read.json(f"{tmp_dir}/topic")
    assert topic.count() == 6
    assert topic.where(F.col("value").contains('"winner":true')).count() == 1
    # tap metrics from the last micro-batch
    metrics = q.lastProgress["observedMetrics"]["entries"]
    assert int(metrics["records"]) == 3


def test_taps_and_conform_batch(spark):
    df = spark.createDataFrame(SAMPLE_RECORDS, "key string, value string")
    from pyspark.sql import Observation
    obs = Observation("t")
    df.observe(obs, F.count(F.lit(1)).alias("n")).collect()
    assert obs.get["n"] == 6
    tapped = with_taps(df, "x")
    assert tapped.count() == 6
    flagged = conform(raffle.flag_entries(df, spark.createDataFrame(
        [], "day date, winnernumber long")), FLAGGED_TABLE)
    assert flagged.schema == FLAGGED_TABLE or [f.name for f in flagged.schema] == \
        [f.name for f in FLAGGED_TABLE]


def test_transcode_declared_stream(spark, tmp_dir):
    from entryflow.schemas import POSTS_TABLE
    posts = [("p1", json.dumps({"title": "t", "body": "b", "url": "u", "view_count": 3,
                                "tags": ["python"]}))]
    write_json(f"{tmp_dir}/in", "a", posts)
    jobs.run_transcode(spark, src(f"{tmp_dir}/in"), POSTS_TABLE, f"{tmp_dir}/out",
                       f"{tmp_dir}/ck", "posts_stream", fmt="parquet", trigger="available_now").awaitTermination()
    row = spark.read.parquet(f"{tmp_dir}/out").head()
    assert row.title == "t" and row.tags == ["python"] and row.view_count == 3


def test_number_stream_continues_across_batches(spark, tmp_dir):
    from entryflow.streaming.numbering import number_stream
    schema = "id long, day string, t long"
    inp = f"{tmp_dir}/in"
    spark.createDataFrame([(1, "d1", 10), (2, "d1", 5), (3, "d2", 1)], schema) \
        .coalesce(1).write.parquet(f"{inp}/a")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1") \
        .parquet(f"{inp}/*")
    args = ("day", ["t", "id"], "n", f"{tmp_dir}/out", f"{tmp_dir}/state", f"{tmp_dir}/ck")
    # epoch_size=1: every batch starts from a snapshot built of the earlier ones
    number_stream(stream, *args, trigger="available_now", epoch_size=1).awaitTermination()
    spark.createDataFrame([(4, "d1", 1), (5, "d3", 1)], schema).coalesce(1) \
        .write.parquet(f"{inp}/b")
    spark.createDataFrame([(6, "d1", 0), (7, "d3", 9)], schema).coalesce(1) \
        .write.parquet(f"{inp}/c")
    number_stream(stream, *args, trigger="available_now", epoch_size=1).awaitTermination()
    # restart: nothing new, nothing re-numbered
    number_stream(stream, *args, trigger="available_now", epoch_size=1).awaitTermination()
    got = {r.id: r.n for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    # batch 0 in t order: id2=0, id1=1, id3=0; later batches continue per day
    assert got[2] == 0 and got[1] == 1 and got[3] == 0
    # the two later files arrive in either order: d1 continues at 2, d3 starts at 0
    assert sorted(got[i] for i in (4, 6)) == [2, 3] and sorted(got[i] for i in (5, 7)) == [0, 1]
    assert os.path.isdir(f"{tmp_dir}/state_snapshots/epoch=2")


def test_sync_to_table_and_tail(spark, tmp_dir):
    from entryflow.streaming.queries import sync_stream_to_table, tail_stream
    from entryflow.sources.topics import read_records_stream
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS)
    parsed = raffle.entries_table(read_records_stream(spark, "json", f"{tmp_dir}/in"))
    spark.sql("DROP TABLE IF EXISTS synced_entries")
    q = sync_stream_to_table(parsed, "synced_entries", f"{tmp_dir}/ck", trigger="available_now")
    q.awaitTermination()
    assert spark.table("synced_entries").count() == 6
    spark.sql("DROP TABLE synced_entries")
    t = tail_stream(parsed, "tail_entries", f"{tmp_dir}/tail", rows=4)
    t.processAllAvailable()
    t.stop()
    assert spark.table("global_temp.tail_entries").count() == 4


def test_tail_keeps_rows_of_quick_micro_batches(spark, tmp_dir):
    from entryflow.sources.topics import read_records_stream
    from entryflow.streaming.queries import tail_stream
    for i, name in enumerate("abc"):
        write_json(f"{tmp_dir}/in", name, SAMPLE_RECORDS[2 * i:2 * i + 2])
    stream = read_records_stream(spark, "json", f"{tmp_dir}/in", {"maxFilesPerTrigger": "1"})
    for rows, seen in ((10, 6), (3, 3)):
        t = tail_stream(stream, f"tail_{rows}", f"{tmp_dir}/tail{rows}", rows=rows)
        t.processAllAvailable()
        t.stop()
        assert spark.table(f"global_temp.tail_{rows}").count() == seen


def test_graceful_stop(spark, tmp_dir):
    from entryflow.streaming.queries import run_until_stopped, stop_gracefully
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS)
    q = jobs.run_entries(spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                         trigger="1 second")
    q.processAllAvailable()
    stop_gracefully(q, timeout_s=30)
    assert not q.isActive and run_until_stopped(q, 1)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 6


def test_flag_entries_on_stream_directly(spark, tmp_dir):
    """Stream-static left join: the aggregated, checked promotion keys are
    the static side; the flag needs no foreachBatch."""
    import datetime as dt
    from entryflow.sources.topics import read_records_stream
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS)
    winners = spark.createDataFrame([(dt.date(2022, 9, 15), 4105)], "day date, winnernumber long")
    stream = read_records_stream(spark, "json", f"{tmp_dir}/in")
    q = (raffle.flag_entries(stream, winners).writeStream.format("memory")
         .queryName("flag_direct").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.participationnumber: r.winner for r in spark.table("flag_direct").collect()}
    assert len(got) == 6 and got[4105.0] is True and sum(got.values()) == 1


def test_jobs_fill_created_tables(spark, tmp_dir):
    """Declared columns only, in both refresh modes; a retried batch adds nothing."""
    from entryflow.schemas import ENTRIES_TABLE, WINNERS_TABLE
    from entryflow.sinks.commits import commit_rows
    from entryflow.sinks.tables import create_table
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS + [record("20220915", 5), ("bad", "not json")])
    promos = spark.createDataFrame(promotion_rows(), PROMO_SCHEMA)
    for name, schema in (("made_entries", ENTRIES_TABLE), ("made_none", WINNERS_TABLE),
                         ("made_batch", WINNERS_TABLE)):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        create_table(spark, name, schema, location=f"{tmp_dir}/{name}")
    jobs.run_entries(spark, src(f"{tmp_dir}/in"), "made_entries", f"{tmp_dir}/ck1", "available_now",
                     as_table=True, dead_letters=f"{tmp_dir}/dead").awaitTermination()
    assert spark.table("made_entries").count() == 7
    assert [r.value for r in spark.read.parquet(f"{tmp_dir}/dead").collect()] == ["not json"]
    for refresh in ("none", "batch"):
        jobs.run_winners(spark, src(f"{tmp_dir}/in"), promos, f"made_{refresh}", f"{tmp_dir}/{refresh}",
                         "available_now", refresh, as_table=True).awaitTermination()
    none, batch = spark.table("made_none"), spark.table("made_batch")
    assert none.columns == batch.columns == [f.name for f in WINNERS_TABLE]
    assert none.collect() == batch.collect() and batch.count() == 1
    rows = spark.createDataFrame(batch.collect(), batch.schema)
    for _ in range(2):
        commit_rows(rows, "made_batch", "again", 7, as_table=True)
    assert spark.table("made_batch").count() == 2
    for name in ("made_entries", "made_none", "made_batch"):
        spark.sql(f"DROP TABLE {name}")


def test_dead_letters_of_the_flagged_job(spark, tmp_dir):
    import datetime as dt
    odd = ("k", '{"email": "a", "campaign": {"x": 1.5}, "participationnumber": 7.25}')
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS[:2] + [odd, ("b1", "not json"), ("b2", "[1]")])
    winners = spark.createDataFrame([(dt.date(2022, 9, 15), 4102)], "day date, winnernumber long")
    jobs.run_flagged(spark, src(f"{tmp_dir}/in"), winners, f"{tmp_dir}/table",
                     {"format": "json", "path": f"{tmp_dir}/topic"}, f"{tmp_dir}/ck",
                     trigger="available_now", as_of=None,
                     dead_letters=f"{tmp_dir}/dead").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/table").count() == 5
    sent = {r.key: json.loads(r.value) for r in spark.read.json(f"{tmp_dir}/topic").collect()}
    assert sent["k"] == {**json.loads(odd[1]), "winner": False} and len(sent) == 3
    dead = spark.read.parquet(f"{tmp_dir}/dead").collect()
    assert {r.key: r.value for r in dead} == {"b1": "not json", "b2": "[1]"}


def test_one_bad_number_stops_neither_batch_nor_stream(spark, tmp_dir):
    rows = [record("20220915", 5), record("20220915", 6, t=1663206958913220.4e12)]
    batch = raffle.entries_table(spark.createDataFrame(rows, "key string, value string")).collect()
    assert [r.entry_time for r in batch] == ["1663243200.5000000", None]
    write_json(f"{tmp_dir}/in", "a", rows)
    jobs.run_entries(spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                     "available_now").awaitTermination()
    assert sorted(map(str, spark.read.parquet(f"{tmp_dir}/out").collect())) == sorted(map(str, batch))


def test_winner_metrics(spark, tmp_dir):
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS + [record("20220915", n) for n in (5, 13, 55)])
    promos = spark.createDataFrame(promotion_rows(), PROMO_SCHEMA)
    q = jobs.run_winners(spark, src(f"{tmp_dir}/in"), promos, f"{tmp_dir}/out", f"{tmp_dir}/ck",
                         "available_now")
    q.awaitTermination()
    taps = q.lastProgress["observedMetrics"]
    assert int(taps["entries"]["records"]) == 9
    assert (int(taps["winners"]["matches"]), int(taps["winners"]["promotions"])) == (3, 2)


def test_broken_state_is_an_error(spark, tmp_dir):
    import pytest
    from entryflow.streaming.numbering import stored_next
    assert stored_next(spark, f"{tmp_dir}/none", "day", 3) is None
    os.makedirs(f"{tmp_dir}/state/epoch=0/batch_id=0")
    with open(f"{tmp_dir}/state/epoch=0/batch_id=0/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        stored_next(spark, f"{tmp_dir}/state", "day", 3).collect()
    os.makedirs(f"{tmp_dir}/empty/epoch=0")
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        stored_next(spark, f"{tmp_dir}/empty", "day", 3)


def test_unique_check_keeps_records_without_key(spark):
    rows = [("a", "1"), (None, "2"), (None, "3"), ("b", "4")]
    df = spark.createDataFrame(rows, "key string, value string")
    assert sorted(r.value for r in raffle.check_unique_entries(df).collect()) == ["1", "2", "3", "4"]
