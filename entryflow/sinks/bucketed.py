"""Questions and answers stored by question, so that joins on it move no answers.

Both tables are bucketed by (question id, slot). ``slot`` is 0 but for hot questions:
those with more answers than a fair part of a bucket's rows. Their answers are dealt over
``SLOTS`` slots, and the question has a row in each, so a question with a third of all
answers is read by many tasks, and a join on (id, slot) finds all that a join on id does.
There can be only few hot questions: each has at least that part of all answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SLOTS = 64
SLOT = "slot"
#: A question is hot with more answers than this part of an average bucket.
HOT_PART = 0.25
#: Answers of an average bucket at most; a task reads and sorts a bucket.
BUCKET_ROWS = 2_000_000


def buckets_for(answers: DataFrame, least: int, rows: int = BUCKET_ROWS) -> int:
    """A number of buckets that grows with the answers, so that buckets do not."""
    return max(least, -(-answers.count() // rows))


def hot_questions(answers: DataFrame, buckets: int) -> DataFrame:
    """``hot_id`` of questions with more than ``HOT_PART / buckets`` of all answers: at most
    ``buckets / HOT_PART`` rows, whatever the size of the tables."""
    per = answers.groupBy(F.col("parent_id").alias("hot_id")).agg(F.count(F.lit(1)).alias("n"))
    least = answers.count() * HOT_PART / buckets
    return per.where((F.col("n") > least) & F.col("hot_id").isNotNull()).select("hot_id")


def with_slots(questions: DataFrame, answers: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Both tables with ``slot``; the bound on hot questions allows their broadcast."""
    hot = F.broadcast(hot_questions(answers, buckets))
    dealt = F.pmod(F.xxhash64(*[F.col(c) for c in answers.columns]), F.lit(SLOTS)).cast("int")
    a = (answers.join(hot, answers["parent_id"] == hot["hot_id"], "left")
         .withColumn(SLOT, F.when(F.col("hot_id").isNotNull(), dealt).otherwise(0)).drop("hot_id"))
    slots = F.when(F.col("hot_id").isNotNull(), F.sequence(F.lit(0), F.lit(SLOTS - 1))).otherwise(F.array(F.lit(0)))
    q = (questions.join(hot, questions["id"] == hot["hot_id"], "left")
         .withColumn(SLOT, F.explode(slots)).drop("hot_id"))
    return q, a


def write_by_question(spark: SparkSession, questions: DataFrame, answers: DataFrame,
                      questions_table: str, answers_table: str, buckets: int) -> None:
    """Write both catalog tables, sorted within their buckets. A task writes whole buckets,
    so there is one file a bucket, not one for each task and bucket."""
    q, a = with_slots(questions, answers, buckets)
    for df, table, key in ((q, questions_table, "id"), (a, answers_table, "parent_id")):
        (df.repartition(buckets, key, SLOT).write.bucketBy(buckets, key, SLOT).sortBy(key, SLOT)
         .format("parquet").saveAsTable(table))


def buckets_of(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])
