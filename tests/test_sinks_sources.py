import json

import pytest

from entryflow.schemas import PROMOTIONS_TABLE, ddl, load_table_schema, struct_from_fields
from entryflow.sinks.tables import append_table, create_table, insert_promotions, promotion_rows
from entryflow.sinks.topics import write_topic
from entryflow.sources.tables import read_day_keyed, read_promotions_for_day
from entryflow.sources.topics import kafka_options, read_records_batch, schema_from_sample

from conftest import SAMPLE_RECORDS


def test_schema_from_field_specs(tmp_dir):
    spec = [{"name": "day", "type": "STRING", "mode": "REQUIRED"},
            {"name": "promotion", "type": "STRING", "mode": "REQUIRED"},
            {"name": "participation_number", "type": "INTEGER", "mode": "REQUIRED"}]
    with open(f"{tmp_dir}/s.json", "w") as fh:
        json.dump(spec, fh)
    st = load_table_schema(f"{tmp_dir}/s.json")
    assert st == PROMOTIONS_TABLE
    assert "`day` string NOT NULL" in ddl(st)
    nested = struct_from_fields([{"name": "tags", "type": "STRING", "mode": "REPEATED"}])
    assert nested.fields[0].dataType.simpleString() == "array<string>"


def test_create_and_required_check(spark, tmp_dir):
    create_table(spark, "promos_t", PROMOTIONS_TABLE, location=f"{tmp_dir}/promos_t")
    insert_promotions(spark, [("x", 5), ("y", 6)], "promos_t", day="20240115")
    assert spark.table("promos_t").count() == 2
    bad = spark.createDataFrame([("20240115", None, 7)],
                                "day string, promotion string, participation_number long")
    with pytest.raises(Exception, match="NULL in required column promotion"):
        append_table(bad, "promos_t", PROMOTIONS_TABLE)
    assert spark.table("promos_t").count() == 2
    spark.sql("DROP TABLE promos_t")


def test_promotion_rows_today(spark):
    import datetime as dt
    rows = promotion_rows(spark, [("x", 5)]).collect()
    assert rows[0].day == dt.date.today().strftime("%Y%m%d")
    ny = dt.date(2021, 1, 1)
    assert promotion_rows(spark, [("x", 5)], ny).head().day == "20210101"
    assert promotion_rows(spark, [("x", 5)], ny, iso_week_year=True).head().day == "20200101"


def test_day_filters(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, 15), 1), (dt.date(2024, 1, 16), 2)],
                               "day date, winnernumber long")
    assert [r.winnernumber for r in read_promotions_for_day(df, "2024-01-16").collect()] == [2]
    keyed = spark.createDataFrame([("20240115", 1)], "day string, n long")
    assert read_day_keyed(keyed, dt.date(2024, 1, 15)).count() == 1


def test_kafka_options():
    o = kafka_options("b:9092", "entries", "KEY", "SECRET",
                      extra={"kafka.request.timeout.ms": 20000})
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "true"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="KEY" password="SECRET"' in o["kafka.sasl.jaas.config"]
    assert o["kafka.request.timeout.ms"] == "20000"
    assert "kafka.sasl.jaas.config" not in kafka_options("b:9092", "t")
    assert kafka_options("b:9092", "t", min_partitions=8)["minPartitions"] == "8"


def test_records_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame(SAMPLE_RECORDS, "key string, value string")
    write_topic(df, {"format": "json", "path": f"{tmp_dir}/topic"})
    back = read_records_batch(spark, "json", f"{tmp_dir}/topic")
    assert sorted(map(tuple, back.collect())) == sorted(SAMPLE_RECORDS)


def test_schema_from_sample(spark):
    st = schema_from_sample(spark, SAMPLE_RECORDS[0][1])
    assert [f.name for f in st.fields] == sorted(
        ["email", "name", "entry_time", "day", "participationnumber"])
