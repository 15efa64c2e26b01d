import datetime as dt

from pyspark.sql import functions as F

from entryflow.functions import (
    classify, daily_winner_key, day_key, email_from_name, entry_key, entry_time_text,
    epoch_seconds, iso_day_key, strip_dashes,
)


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("r")).collect()


def test_day_keys(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 1, 15),)], "d date")
    rows = df.select(day_key("d").alias("cal"), iso_day_key("d").alias("iso"),
                     strip_dashes("d").alias("s")).collect()
    assert [tuple(r) for r in rows] == [("20210101", "20200101", "20210101"),
                                        ("20240115", "20240115", "20240115")]


def test_entry_keys(spark):
    df = spark.createDataFrame([("20240115", 5), (None, 5)], "day string, n long")
    assert [r[0] for r in df.select(entry_key("day", "n")).collect()] == ["20240115_5", None]
    dw = spark.createDataFrame([(dt.date(2024, 1, 15), 13)], "day date, w long")
    assert dw.select(daily_winner_key("day", "w")).head()[0] == "20240115_13"


def test_epoch_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    # independent of the session time zone
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        v = df.select(epoch_seconds("ts")).head()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert v == 1704067207.179575
    t = spark.range(1).select(entry_time_text(F.lit(1663243210.1234567))).head()[0]
    assert t == "1663243210.1234567"


def test_email(spark):
    df = spark.createDataFrame([("Nora  Pillbug",), (None,)], "name string")
    assert [r[0] for r in df.select(email_from_name("name", "mail.kz")).collect()] == \
        ["norapillbug@mail.kz", None]


def test_classify_first_rule_wins(spark):
    tags = ["Python-3.x", "javascript", "mysql", "reactive", "go", None, "node.js", "C++", "c#",
            "ruby-on-rails", "css3", "html5"]
    df = spark.createDataFrame([(t,) for t in tags], "tag string")
    got = [r[0] for r in df.select(classify("tag")).collect()]
    assert got == ["Python", "Java", "SQL", "React", "NA", "NA", "Node.js", "C++", "C#",
                   "Ruby", "CSS", "HTML"]


def test_classify_custom_rules(spark):
    df = spark.createDataFrame([("a_b",), ("x%y",)], "t string")
    got = [r[0] for r in df.select(classify("t", [("_", "under"), ("%", "pct")], "none")).collect()]
    assert got == ["under", "pct"]  # keywords are literal text, not LIKE patterns
