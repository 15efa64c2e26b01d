"""Plan properties the scale design relies on (regression guards)."""

import contextlib
import io

import pytest

from entryflow.plans import catalog, reports
from entryflow.sources import driver_tables as dt

from conftest import SF_SMALL


def plan_text(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture()
def at_volume(spark):
    """Plan as if no side fits a broadcast (static plan, no AQE)."""
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("name,most", [("days_to_answer", 7), ("active_vs_total", 15),
                                       ("posts_by_language", 3)])
def test_exchange_budget_at_volume(at_volume, name, most):
    text = plan_text(catalog.QUERIES[name](at_volume, SF_SMALL))
    # one line per exchange node (a ReusedExchange line also names its source)
    assert sum("Exchange" in line for line in text.splitlines()) <= most


def test_top_k_bound_reaches_the_scan(spark, tmp_dir):
    dt.posts(spark, SF_SMALL).write.parquet(f"{tmp_dir}/posts")
    top = reports.top_viewed(spark.read.parquet(f"{tmp_dir}/posts"))
    top.collect()
    text = plan_text(top, "formatted")
    assert "Or(GreaterThanOrEqual(view_count,ScalarSubquery" in text


def test_entry_side_not_shuffled_for_promotions(spark):
    df = catalog.QUERIES["winners_inner"](spark, SF_SMALL)
    df.collect()
    text = plan_text(df).split("Initial Plan")[0]
    # promotions and slice offsets are broadcast by the planner's size checks:
    # what is exchanged is per-slice counts, not entries
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "_nb_" in line or "day#" in line


def test_json_parsed_once(spark):
    text = plan_text(catalog.QUERIES["winners_inner"](spark, SF_SMALL), "extended")
    physical = text.split("== Physical Plan ==")[1]
    assert physical.count("from_json(") == 1


def test_day_filter_prunes_partitions(spark, tmp_dir):
    from entryflow.sources.tables import read_promotions_for_day
    dt.daily_winners(spark, SF_SMALL).write.partitionBy("day").parquet(f"{tmp_dir}/dw")
    one_day = read_promotions_for_day(spark.read.parquet(f"{tmp_dir}/dw"), "2024-01-15")
    text = plan_text(one_day, "formatted")
    assert "PartitionFilters: [isnotnull(day" in text and "2024-01-15" in text
    assert one_day.count() == 15


@pytest.fixture()
def skewed(spark):
    """Two thirds of the questions on one title, two thirds of the answers on one
    question; no broadcasts, and skew thresholds that this size reaches."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    n = spark.range(0, 200_000, 1, 8)
    title = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id")))
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 900).cast("int"))
    posts = n.select(title.alias("title"), F.lit("b").alias("body"),
                     F.concat(F.lit("u"), F.col("id")).alias("url"), F.col("id").alias("view_count"),
                     F.array(F.lit("python"), F.lit("mysql")).alias("tags"))
    questions = n.select("id", title.alias("title"), day.alias("creation_date"),
                         (F.col("id") % 5000).alias("owner_user_id"))
    answers = n.select(F.when(F.col("id") % 3 != 0, F.lit(7).cast("long")).otherwise(F.col("id"))
                       .alias("parent_id"), F.date_add(day, 3).alias("creation_date"),
                       (F.col("id") % 7000).alias("owner_user_id"))
    users = spark.range(6000).select("id", day.alias("creation_date"))
    yield posts, questions, answers, users
    for k, v in old.items():
        spark.conf.set(k, v)


def skew_joins(df):
    """Join lines of the final plan that AQE split."""
    df.collect()
    final = plan_text(df).split("== Initial Plan ==")[0]
    return [line for line in final.splitlines() if "skew=true" in line]


def test_hot_title_is_split_in_days_to_answer(skewed):
    posts, questions, answers, _ = skewed
    assert any("title" in line for line in skew_joins(reports.days_to_answer(posts, questions, answers)))


def test_hot_title_and_hot_question_are_split_in_active_users(skewed):
    lines = skew_joins(reports.active_vs_total(*skewed))
    assert any("title" in line and "LeftSemi" in line for line in lines)
    assert any("parent_id" in line and "LeftSemi" in line for line in lines)


def test_sql_reports_split_hot_keys_too(skewed):
    from entryflow.plans import sql_reports
    spark = skewed[0].sparkSession
    sql_reports.register_report_views(spark, *skewed, prefix="sk_")
    assert any("title" in x for x in skew_joins(sql_reports.run_report(spark, "days_to_answer", "sk_")))
    lines = skew_joins(sql_reports.run_report(spark, "active_vs_total", "sk_"))
    assert any("title" in x for x in lines) and any("parent_id" in x for x in lines)


@pytest.fixture()
def by_question(skewed):
    """The skewed tables stored by question, in 16 buckets."""
    import uuid
    from entryflow.sinks.bucketed import write_by_question
    posts, questions, answers, users = skewed
    spark = posts.sparkSession
    names = [f"qa_{uuid.uuid4().hex}" for _ in range(2)]
    write_by_question(spark, questions, answers, *names, buckets=16)
    yield posts, spark.table(names[0]), spark.table(names[1]), users, names
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def exchanged(df, column):
    """Hash exchanges of the final plan on a column (by its name), and the plan."""
    final = plan_text(df).split("== Initial Plan ==")[0]
    return [x for x in final.splitlines() if "Exchange hashpartitioning" in x and f"({column}#" in x], final


def test_answers_stored_by_question_are_not_exchanged(by_question, skewed):
    posts, questions, answers, users, names = by_question
    days = reports.days_to_answer(posts, questions, answers, buckets=16)
    active = reports.active_vs_total(posts, questions, answers, users)
    for stored, plain in ((days, reports.days_to_answer(*skewed[:3])), (active, reports.active_vs_total(*skewed))):
        assert stored.collect() == plain.collect()
        moved, plan = exchanged(stored, "parent_id")
        assert not moved and "Bucketed: true" in plan
        assert exchanged(plain, "parent_id")[0]


def test_a_hot_question_is_spread_over_buckets(by_question):
    from pyspark.sql import functions as F
    _, questions, answers, _, names = by_question
    from entryflow.sinks.bucketed import SLOTS, buckets_of
    assert buckets_of(answers.sparkSession, names[1]) == 16
    files = [r.n for r in answers.groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(files) == 16 and max(files) < 2 * sum(files) / 16
    assert questions.where("id = 7").count() == SLOTS and questions.where("id <> 7").count() == 199_999
    assert answers.where("parent_id <> 7 and slot <> 0").count() == 0


@pytest.mark.parametrize("name", ["days_to_answer", "days_to_answer_sql"])
def test_a_question_is_one_row_until_its_days_are_known(at_volume, name):
    # no table of (question, language): its size in a task would be a multiple of the questions'
    text = plan_text(catalog.QUERIES[name](at_volume, SF_SMALL), "formatted")
    keys = [line for line in text.splitlines() if line.startswith("Keys") and "[id#" in line]
    assert not any("programming_language" in line for line in keys)
    lines = plan_text(catalog.QUERIES[name](at_volume, SF_SMALL)).splitlines()
    exploded = next(i for i, x in enumerate(lines) if "Generate explode(" in x)
    assert any("SortMergeJoin [id#" in x for x in lines[exploded:])


def test_buckets_grow_with_the_answers(spark):
    from entryflow.sinks.bucketed import buckets_for
    assert [buckets_for(spark.range(n), 2, rows=10) for n in (0, 20, 21, 95)] == [2, 2, 3, 10]


def test_stored_tables_get_more_buckets_for_more_answers(spark, monkeypatch):
    from entryflow.sinks import bucketed
    seen = []
    monkeypatch.setattr(catalog, "buckets_for", lambda a, least: bucketed.buckets_for(a, least, rows=500))
    monkeypatch.setattr(catalog, "write_by_question",
                        lambda *x, buckets: (seen.append(buckets), bucketed.write_by_question(*x, buckets=buckets)))
    got = catalog.QUERIES["days_to_answer_bucketed"](spark, SF_SMALL).collect()
    assert seen == [12] and got == catalog.QUERIES["days_to_answer"](spark, SF_SMALL).collect()
