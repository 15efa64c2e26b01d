"""One commit list per table: any writers in any order, retries, cut-off attempts, compaction."""

import itertools
import json
import os
import threading

import pytest

from entryflow.plans import jobs
from entryflow.schemas import ENTRIES_TABLE, WINNERS_TABLE
from entryflow.sinks import commits
from entryflow.sinks.commits import commit_rows, compact, read_table, settle
from entryflow.sinks.tables import append_table, create_table

from conftest import SAMPLE_RECORDS, promotion_rows, record
from test_streaming import PROMO_SCHEMA, src, write_json

ROWS = "n long, word string"


def rows(spark, *numbers):
    return spark.createDataFrame([(n, f"w{n}") for n in numbers], ROWS).coalesce(1)


def numbers(df):
    return sorted(r.n for r in df.select("n").collect())


def both(spark, path):
    """What a plain reader and a reader of the list see."""
    return numbers(spark.read.schema(ROWS).parquet(path)), numbers(read_table(spark, path))


def test_a_commit_counts_once(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    assert commit_rows(rows(spark, 1, 2), t, "q", 0)
    assert not commit_rows(rows(spark, 1, 2), t, "q", 0)
    assert commit_rows(rows(spark, 3), t, "q", 1) and commit_rows(rows(spark, 4), t, "other", 0)
    assert commit_rows(rows(spark, 5), t) and commit_rows(rows(spark, 5), t)
    assert both(spark, t) == ([1, 2, 3, 4, 5, 5],) * 2
    assert spark.read.parquet(t).columns == ["n", "word"]
    # unnamed commits leave no record, named ones one each
    assert len(os.listdir(f"{t}/_commits/list")) - sum(f.startswith(".") for f in os.listdir(f"{t}/_commits/list")) == 3


def test_rows_of_other_writers_stay(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    rows(spark, 7).write.parquet(t)
    commit_rows(rows(spark, 1), t, "q", 0)
    rows(spark, 8).write.mode("append").parquet(t)
    assert both(spark, t) == ([1, 7, 8],) * 2


def cut_off(monkeypatch, where):
    def fail(*_):
        raise RuntimeError("lost driver")
    monkeypatch.setattr(commits.CommitList, where, fail)


def test_cut_off_before_the_record(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    commit_rows(rows(spark, 9), t, "q", 0)
    with monkeypatch.context() as m:
        cut_off(m, "add")
        with pytest.raises(RuntimeError):
            commit_rows(rows(spark, 1, 2), t, "q", 1)
    assert both(spark, t) == ([9],) * 2  # nothing counts, nothing is hidden
    assert commit_rows(rows(spark, 1, 2), t, "q", 1)
    assert both(spark, t) == ([1, 2, 9],) * 2
    settle(spark, t)  # takes away what the first attempt left
    assert [f for f in os.listdir(f"{t}/_commits/files") if not f.startswith(".")] == []


def test_cut_off_after_the_record(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    commit_rows(rows(spark, 9), t, "q", 0)
    with monkeypatch.context() as m:
        cut_off(m, "publish")
        with pytest.raises(RuntimeError):
            commit_rows(rows(spark, 1, 2), t, "q", 1)
    assert both(spark, t) == ([9],) * 2
    assert not commit_rows(rows(spark, 100), t, "q", 1)  # the retry only finishes it
    assert both(spark, t) == ([1, 2, 9],) * 2


def test_cut_off_between_two_files(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    moved = itertools.count()
    real = commits.Folder.move

    def move(self, name, to):
        if "part-" in name and next(moved) >= 1:
            raise RuntimeError("lost driver")
        return real(self, name, to)

    with monkeypatch.context() as m:
        m.setattr(commits.Folder, "move", move)
        m.setattr(commits, "THREADS", 1)
        with pytest.raises(RuntimeError):
            commit_rows(rows(spark, *range(30)).repartition(5), t, "q", 0)
    assert 0 < len(numbers(spark.read.parquet(t))) < 30 and numbers(read_table(spark, t)) == []
    settle(spark, t)
    assert both(spark, t) == (list(range(30)),) * 2


def test_two_drivers_write_the_same_commit(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    added = []

    def write():
        added.append(commit_rows(rows(spark, *range(20)).repartition(4), t, "q", 3))

    threads = [threading.Thread(target=write) for _ in range(4)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert sorted(added) == [False, False, False, True]
    settle(spark, t)
    assert both(spark, t) == (list(range(20)),) * 2


def test_records_of_a_long_stream_are_forgotten(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(commits, "KEEP", 3)
    for i in range(6):
        commit_rows(rows(spark, i), f"{tmp_dir}/t", "q", i)
    left = [f for f in os.listdir(f"{tmp_dir}/t/_commits/list") if f.endswith(".json")]
    assert sorted(left) == [f"q-{i:012d}.json" for i in (3, 4, 5)]
    assert both(spark, f"{tmp_dir}/t") == (list(range(6)),) * 2


def test_a_file_sinks_log_is_refused(spark, tmp_dir):
    rows(spark, 1).write.parquet(f"{tmp_dir}/in")
    (spark.readStream.schema(ROWS).parquet(f"{tmp_dir}/in").writeStream.format("parquet")
     .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start(f"{tmp_dir}/t").awaitTermination())
    with pytest.raises(ValueError, match="_spark_metadata"):
        commit_rows(rows(spark, 2), f"{tmp_dir}/t")
    assert numbers(spark.read.parquet(f"{tmp_dir}/t")) == [1]


def test_partitions(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS by_word")
    create_table(spark, "by_word", spark.createDataFrame([], ROWS).schema, location=f"{tmp_dir}/t",
                 partition_by=["word"])
    for i in range(3):
        commit_rows(rows(spark, 1, 2), "by_word", "q", i, as_table=True, partition_by=["word"])
    assert numbers(spark.table("by_word")) == numbers(read_table(spark, "by_word", as_table=True)) == [1, 1, 1, 2, 2, 2]
    assert numbers(spark.table("by_word").where("word = 'w2'")) == [2] * 3
    assert compact(spark, "by_word", as_table=True) == 6
    seen = read_table(spark, "by_word", as_table=True)
    assert numbers(seen.where("word = 'w1'")) == [1] * 3 and numbers(seen) == [1, 1, 1, 2, 2, 2]
    settle(spark, "by_word", as_table=True)
    assert numbers(spark.table("by_word")) == [1, 1, 1, 2, 2, 2] and len(spark.table("by_word").inputFiles()) == 2
    spark.sql("DROP TABLE by_word")


# -- compaction ---------------------------------------------------------------

def test_compaction_keeps_every_row_once_at_any_moment(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    for i in range(8):
        commit_rows(rows(spark, i, i + 100), t, "q", i)
    rows(spark, 500).write.mode("append").parquet(t)
    want = sorted([*range(8), *range(100, 108), 500])
    assert compact(spark, t) == len(spark.read.parquet(t).inputFiles())
    assert both(spark, t) == (want,) * 2  # plain readers go on with the old files
    assert len(read_table(spark, t).inputFiles()) == 1
    commit_rows(rows(spark, 900), t, "q", 8)
    assert both(spark, t) == (want + [900],) * 2
    # cut off in the middle of the swap: new files published, old ones still there
    real = commits.Folder.delete
    with monkeypatch.context() as m:
        m.setattr(commits.Folder, "delete", lambda self, name: (_ for _ in ()).throw(RuntimeError("lost driver"))
                  if name.startswith("part-") else real(self, name))
        with pytest.raises(RuntimeError):
            settle(spark, t)
    assert numbers(read_table(spark, t)) == want + [900]
    settle(spark, t)
    assert both(spark, t) == (want + [900],) * 2
    assert len(spark.read.parquet(t).inputFiles()) == 2
    assert compact(spark, t) == 2 and compact(spark, t, small_bytes=10) == 0


def test_readers_while_files_are_merged_and_written(spark, tmp_dir):
    t, seen, stop = f"{tmp_dir}/t", [], threading.Event()
    for i in range(4):
        commit_rows(rows(spark, i), t, "q", i)

    def read():
        while not stop.is_set():
            seen.append(numbers(read_table(spark, t)))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(4, 8):
        commit_rows(rows(spark, i), t, "q", i)
        compact(spark, t)
    stop.set()
    reader.join()
    assert seen and all(s == list(range(len(s))) and len(s) >= 4 for s in seen)
    assert numbers(read_table(spark, t)) == list(range(8))


def test_of_two_compactions_one_counts(spark, tmp_dir, monkeypatch):
    t = f"{tmp_dir}/t"
    for i in range(3):
        commit_rows(rows(spark, i), t, "q", i)
    real = commits.CommitList.add

    def late(self, commit, *rest):  # another compaction comes first
        monkeypatch.setattr(commits.CommitList, "add", real)
        assert compact(spark, t) == 3
        return real(self, commit, *rest)

    monkeypatch.setattr(commits.CommitList, "add", late)
    assert compact(spark, t) == 0
    assert numbers(read_table(spark, t)) == [0, 1, 2]
    settle(spark, t)
    assert both(spark, t) == ([0, 1, 2],) * 2


# -- the jobs -----------------------------------------------------------------

def entry_writers(spark, tmp_dir, target):
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS[:2])
    write_json(f"{tmp_dir}/in", "b", SAMPLE_RECORDS[2:])
    batch = spark.createDataFrame([("b@x.org", "B", "1", "20220915", n) for n in range(7)], ENTRIES_TABLE)

    def stream(name, dead=None):
        return lambda: jobs.run_entries(spark, src(f"{tmp_dir}/in"), target, f"{tmp_dir}/ck-{name}", "available_now",
                                        as_table=True, dead_letters=dead).awaitTermination()
    return {"batch": lambda: append_table(batch, target, ENTRIES_TABLE, by_path=False),
            "plain": stream("plain"), "dead": stream("dead", f"{tmp_dir}/dead")}


@pytest.mark.parametrize("order", [("batch", "plain", "dead"), ("plain", "batch", "dead"), ("dead", "plain", "batch")])
def test_entries_by_any_writers_in_any_order(spark, tmp_dir, order):
    name = "mixed_" + "_".join(order)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    create_table(spark, name, ENTRIES_TABLE, location=f"{tmp_dir}/t")
    writers = entry_writers(spark, tmp_dir, name)
    count = 0
    for writer in order:
        writers[writer]()
        count += 7 if writer == "batch" else len(SAMPLE_RECORDS)
        assert spark.table(name).count() == read_table(spark, name, as_table=True).count() == count
    writers["plain"]()  # a restart adds nothing
    assert spark.table(name).count() == count
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("order", [("none", "batch"), ("batch", "none")])
def test_winners_in_both_modes_on_one_folder(spark, tmp_dir, order):
    write_json(f"{tmp_dir}/in", "a", [record("20220915", n) for n in (5, 13, 14)])
    promos = spark.createDataFrame(promotion_rows(), PROMO_SCHEMA)
    append_table(spark.createDataFrame([("e", "n", "1", "d", 1, "p")], WINNERS_TABLE), f"{tmp_dir}/t")
    for i, refresh in enumerate(order):
        jobs.run_winners(spark, src(f"{tmp_dir}/in"), promos, f"{tmp_dir}/t", f"{tmp_dir}/ck{i}", "available_now",
                         refresh).awaitTermination()
        assert spark.read.parquet(f"{tmp_dir}/t").count() == 1 + 2 * (i + 1)


def test_a_retried_micro_batch_adds_nothing(spark, tmp_dir):
    """The checkpoint's commit of the last batch is lost: the batch is run again."""
    write_json(f"{tmp_dir}/in", "a", SAMPLE_RECORDS)
    args = (spark, src(f"{tmp_dir}/in"), f"{tmp_dir}/t", f"{tmp_dir}/ck", "available_now")
    jobs.run_entries(*args).awaitTermination()
    last = max(f for f in os.listdir(f"{tmp_dir}/ck/commits") if f.isdigit())
    for f in (last, f".{last}.crc"):
        if os.path.exists(f"{tmp_dir}/ck/commits/{f}"):
            os.remove(f"{tmp_dir}/ck/commits/{f}")
    q = jobs.run_entries(*args)
    q.awaitTermination()
    assert q.lastProgress["batchId"] == int(last)
    assert spark.read.parquet(f"{tmp_dir}/t").count() == len(SAMPLE_RECORDS)
    # a new checkpoint is a new writer
    jobs.run_entries(*args[:3], f"{tmp_dir}/ck2", "available_now").awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2 * len(SAMPLE_RECORDS)
    records = [json.load(open(f"{tmp_dir}/t/_commits/list/{f}")) for f in os.listdir(f"{tmp_dir}/t/_commits/list")
               if f.endswith(".json") and not f.startswith(".")]
    assert len({r["commit"].rpartition("-")[0] for r in records}) == 2
