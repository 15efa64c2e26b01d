import json
import os

import pytest

from entryflow.cli import build_parser, main

from conftest import SAMPLE_RECORDS, promotion_rows, record


def write_json(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/a.json", "w") as fh:
        for k, v in rows:
            fh.write(json.dumps({"key": k, "value": v}) + "\n")


def test_winners_job_from_cli(spark, tmp_dir):
    write_json(f"{tmp_dir}/in", SAMPLE_RECORDS + [record("20220915", 13)])
    spark.createDataFrame(promotion_rows(), "day string, promotion string, participation_number long") \
        .write.parquet(f"{tmp_dir}/promos")
    q = main(["winners", "--source", "json", "--path", f"{tmp_dir}/in",
              "--promotions", f"{tmp_dir}/promos", "--target", f"{tmp_dir}/out",
              "--checkpoint", f"{tmp_dir}/ck", "--trigger", "available_now"], spark=spark)
    q.awaitTermination()
    assert [r.participation_number for r in spark.read.parquet(f"{tmp_dir}/out").collect()] == [13]


def test_promotions_and_report_from_cli(spark, tmp_dir):
    main(["promotions", "--target", f"{tmp_dir}/p", "--day", "20240115",
          "--offer", "A week, somewhere=21", "--offer", "Cruise=5"], spark=spark)
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/p").collect())
    assert rows == [("20240115", "A week, somewhere", 21), ("20240115", "Cruise", 5)]
    spark.createDataFrame([("t", "b", "u", 3, ["python"])],
                          "title string, body string, url string, view_count long, "
                          "tags array<string>").write.parquet(f"{tmp_dir}/posts")
    df = main(["report", "posts_by_language", "--posts", f"{tmp_dir}/posts"], spark=spark)
    assert [tuple(r) for r in df.collect()] == [("Python", 1)]
    with pytest.raises(SystemExit):
        main(["report", "days_to_answer", "--posts", f"{tmp_dir}/posts"], spark=spark)


def test_kafka_source_options_not_printed(capsys):
    a = build_parser().parse_args(["entries", "--bootstrap", "b:9092", "--topic", "t",
                                   "--api-key", "K", "--api-secret", "S3CRET",
                                   "--target", "x", "--checkpoint", "y"])
    from entryflow.cli import _source
    src = _source(a)
    assert 'password="S3CRET"' in src["options"]["kafka.sasl.jaas.config"]
    assert "S3CRET" not in capsys.readouterr().out
    with pytest.raises(SystemExit):
        build_parser().parse_args(["winners", "--target", "x", "--checkpoint", "y"])


def test_flagged_job_from_cli(spark, tmp_dir):
    import datetime as dt
    write_json(f"{tmp_dir}/in", SAMPLE_RECORDS)
    spark.createDataFrame([(dt.date(2022, 9, 15), 4103)], "day date, winnernumber long") \
        .write.parquet(f"{tmp_dir}/dw")
    q = main(["flagged", "--source", "json", "--path", f"{tmp_dir}/in",
              "--daily-winners", f"{tmp_dir}/dw", "--as-of", "2022-09-15",
              "--target", f"{tmp_dir}/table", "--out-path", f"{tmp_dir}/records",
              "--checkpoint", f"{tmp_dir}/ck", "--trigger", "available_now"], spark=spark)
    q.awaitTermination()
    table = spark.read.parquet(f"{tmp_dir}/table")
    assert table.count() == 6 and [r.participationnumber for r in table.where("winner").collect()] == [4103.0]
    assert spark.read.json(f"{tmp_dir}/records").count() == 6


def test_topic_options_reach_source_and_sink():
    from entryflow.cli import _source
    from entryflow.sinks.topics import kafka_sink
    a = build_parser().parse_args(["entries", "--bootstrap", "b:9092", "--topic", "t", "--target", "x",
                                   "--checkpoint", "y", "--max-offsets-per-trigger", "500",
                                   "--option", "kafka.request.timeout.ms=60000",
                                   "--option", "groupIdPrefix=g=1"])
    options = _source(a)["options"]
    assert options["maxOffsetsPerTrigger"] == "500" and options["groupIdPrefix"] == "g=1"
    assert kafka_sink("out", options) == {"format": "kafka", "topic": "out", "options": {
        "kafka.bootstrap.servers": "b:9092", "kafka.request.timeout.ms": "60000"}}
    # a first micro-batch is bounded without asking for it
    a = build_parser().parse_args(["entries", "--bootstrap", "b", "--topic", "t", "--target", "x",
                                   "--checkpoint", "y"])
    assert int(_source(a)["options"]["maxOffsetsPerTrigger"]) > 0


def test_entries_job_fills_a_table_from_cli(spark, tmp_dir):
    from entryflow.schemas import ENTRIES_TABLE
    from entryflow.sinks.tables import create_table
    write_json(f"{tmp_dir}/in", SAMPLE_RECORDS)
    spark.sql("DROP TABLE IF EXISTS cli_entries")
    create_table(spark, "cli_entries", ENTRIES_TABLE, location=f"{tmp_dir}/t")
    main(["entries", "--source", "json", "--path", f"{tmp_dir}/in", "--target", "cli_entries",
          "--as-table", "--checkpoint", f"{tmp_dir}/ck", "--trigger", "available_now"],
         spark=spark).awaitTermination()
    assert spark.table("cli_entries").count() == 6
    spark.sql("DROP TABLE cli_entries")
