from hypothesis import HealthCheck, given, settings, strategies as st

from entryflow.plans import raffle
from entryflow.operators.ranking import row_share, running_total

from conftest import record

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(entries=st.lists(st.integers(0, 30), max_size=25),
       promos=st.sets(st.integers(0, 30), max_size=10))
def test_flag_count_equals_inner_matches(spark, entries, promos):
    import datetime as dt
    kv = spark.createDataFrame([record("20220915", n) for n in entries] or [],
                               "key string, value string")
    prom = spark.createDataFrame([("20220915", "p", n) for n in promos] or [],
                                 "day string, promotion string, participation_number long")
    daily = spark.createDataFrame([(dt.date(2022, 9, 15), n) for n in promos] or [],
                                  "day date, winnernumber long")
    flagged = raffle.flag_entries(kv, daily)
    assert flagged.count() == len(entries)
    assert flagged.where("winner").count() == raffle.winners(kv, prom).count() == \
        sum(1 for n in entries if n in promos)


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(1990, 1995), st.integers(0, 50)), min_size=1,
                     max_size=20))
def test_running_total_and_shares(spark, vals):
    df = spark.createDataFrame(vals, "year long, n long")
    rows = running_total(df, "year", "n", "total").orderBy("year").collect()
    totals = [r.total for r in rows]
    assert totals == sorted(totals) and totals[-1] == sum(v for _, v in vals)
    shares = row_share(spark.createDataFrame([(a + 1, b + 1) for a, b in vals], "a long, b long"),
                       ["a", "b"]).collect()
    assert all(abs(r.a_share + r.b_share - 1) < 1e-12 for r in shares)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 5)),
                     min_size=1, max_size=40),
       parts=st.integers(1, 6))
def test_range_split_equals_window(spark, rows, parts):
    from pyspark.sql import Window, functions as F
    from entryflow.operators.numbering import assign_numbers
    df = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(rows)],
                               "id long, g string, t long")
    split = assign_numbers(df, "g", ["t", "id"], out_col="n", num_partitions=parts)
    w = Window.partitionBy("g").orderBy("t", "id")
    exp = {r.id: r.e for r in df.select("id", (F.row_number().over(w) - 1).alias("e")).collect()}
    got = {r.id: r.n for r in split.collect()}
    assert got == exp
