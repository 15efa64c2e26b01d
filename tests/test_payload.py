from pyspark.sql import functions as F

from entryflow.operators.payload import add_json_field, kv_strings, parse_entries, split_objects
from entryflow.plans import raffle

from conftest import SAMPLE_RECORDS


def kv(spark, rows):
    return spark.createDataFrame(rows, "key string, value string")


def test_parse_sample_records(spark):
    out = parse_entries(kv(spark, SAMPLE_RECORDS))
    assert out.columns == ["email", "name", "entry_time", "day", "participation_number"]
    rows = out.orderBy("participation_number").collect()
    assert [r.participation_number for r in rows] == list(range(4101, 4107))
    assert rows[0].email == "nora.pillbug@example.org" and rows[0].day == "20220915"
    assert rows[0].entry_time == 1663243210.1234567


def test_entries_table_text_time(spark):
    row = raffle.entries_table(kv(spark, SAMPLE_RECORDS[:1])).head()
    assert row.entry_time == "1663243210.1234567"


def test_binary_key_value_cast(spark):
    df = spark.createDataFrame([(bytearray(b"k1"), bytearray(b'{"day": "20220915"}'))],
                               "key binary, value binary")
    got = kv_strings(df, key_alias="case_id", value_alias="json_payload").head()
    assert got.case_id == "k1" and got.json_payload == '{"day": "20220915"}'


def test_permissive_fields(spark):
    rows = [
        ("a", None),
        ("b", "not json"),
        ("c", '{"participationnumber": "7", "day": "20220915"}'),
        ("d", '{"participationnumber": 5.0, "day": "20220915"}'),
        ("e", '{"participationnumber": 3000000000, "day": "20220915"}'),
        ("f", '{"participationnumber": 8, "day": 20220915}'),
    ]
    out = {r.key: r for r in parse_entries(kv(spark, rows), keep=["key"]).collect()}
    assert len(out) == 6  # every row kept
    assert all(v is None for v in out["a"][1:]) and all(v is None for v in out["b"][1:])
    for k in "cde":
        assert out[k].participation_number is None and out[k].day == "20220915"
    assert out["f"].day == "20220915" and out["f"].participation_number == 8


def test_on_bad_drop_and_split(spark):
    rows = SAMPLE_RECORDS[:2] + [("x", "garbage"), ("y", None)]
    assert parse_entries(kv(spark, rows), on_bad="drop").count() == 2
    good, bad = parse_entries(kv(spark, rows), keep=["key"], on_bad="split")
    assert good.count() == 2
    assert sorted(r.key for r in bad.collect()) == ["x", "y"]


def test_add_json_field_keeps_fields(spark):
    df = kv(spark, SAMPLE_RECORDS[:1])
    out = df.select(add_json_field("value", "winner", F.lit(True)).alias("v"))
    parsed = out.select(F.from_json("v", "email string, participationnumber int, winner boolean")
                        .alias("j")).select("j.*").head()
    assert tuple(parsed) == ("nora.pillbug@example.org", 4101, True)


def test_registry_framed_values(spark):
    from entryflow.operators.payload import REGISTRY_HEADER_BYTES
    framed = bytearray(b"\x00\x00\x00\x00\x07") + bytearray(SAMPLE_RECORDS[0][1].encode())
    df = spark.createDataFrame([(bytearray(b"k"), framed)], "key binary, value binary")
    out = parse_entries(kv_strings(df, value_header_bytes=REGISTRY_HEADER_BYTES)).head()
    assert out.participation_number == 4101 and out.email == "nora.pillbug@example.org"
    # without dropping the frame the value is not JSON: all fields NULL
    assert parse_entries(kv_strings(df)).head().participation_number is None


def test_add_json_field_keeps_unknown_and_nested_fields(spark):
    import json
    docs = {
        "a": '{"email":"a","participationnumber":5.5,"campaign":{"x":[1,null]},"winner":"old"}',
        "b": "{}", "c": '{"n":null,"big":123456789012345678901234567890}'}
    bad = {"x": "not json", "y": None, "z": "[1,2]", "w": '{"a":1', "v": '"text"'}
    df = kv(spark, list(docs.items()) + list(bad.items()))
    out = {r.key: r.v for r in df.select(
        "key", add_json_field("value", "winner", F.col("key") == "a").alias("v")).collect()}
    for key, doc in docs.items():
        assert json.loads(out[key]) == {**json.loads(doc), "winner": key == "a"}
    assert all(out[key] is None for key in bad)
    good, rejected = split_objects(df)
    assert {r.key for r in good.collect()} == set(docs)
    assert {r.key: r.value for r in rejected.collect()} == bad


def test_entry_time_as_number_text_or_nonsense(spark):
    rows = [("n", '{"entry_time": 1663243210.1234567, "day": "d"}'),
            ("t", '{"entry_time": "1663243210.5", "day": "d"}'),
            ("micros", '{"entry_time": 1663243210123456789012.4, "day": "d"}'),
            ("x", '{"entry_time": "soon", "day": "d"}'), ("null", '{"day": "d"}')]
    table = raffle.entries_table(kv(spark, rows)).collect()
    assert [r.entry_time for r in table] == ["1663243210.1234567", "1663243210.5000000", None, None, None]
    assert all(r.day == "d" for r in table)
    parsed = [r.entry_time for r in parse_entries(kv(spark, rows)).collect()]
    assert parsed[:2] == [1663243210.1234567, 1663243210.5] and parsed[3:] == [None, None]
