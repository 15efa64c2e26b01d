"""The reference's tables, derived by Spark from the driver's test tables.

| shape       | derived from | how |
| ----------- | ------------ | --- |
| entries     | events       | day of ``ts``, dense number per day in (ts, event_id) order, name/email from user_id |
| entries_kv  | entries      | key ``<day>_<number>``, value = JSON payload |
| promotions  | entries days | every day x the fixed promotion offers |
| posts       | orders       | title/body/url/view_count, two tags from a fixed list (NULL or empty for some) |
| questions   | orders       | id, title, creation date, owner |
| answers     | lineitem     | parent id, ship date as creation date, part key as owner |
| users       | customer     | id, creation date spread over 2400 days from 1995-01-01 |

Every row of the source tables is used; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from entryflow.functions.keys import day_key, email_from_name, entry_key, epoch_seconds
from entryflow.operators.numbering import assign_numbers
from entryflow.operators.payload import to_records
from entryflow.schemas import KV_SCHEMA
from entryflow.session import scratch_path

# The daily promotion offers (promotion text, participation
# number) as inserted for each day in the reference's lab, in insert order.
PROMOTION_OFFERS: tuple[tuple[str, int], ...] = (
    ("5 day cruise to Alaska", 5),
    ("14 day hiking trip to Kilimanjaro, Tanzania", 13),
    ("A week in Cambodia", 21),
    ("5 day cruise to Alaska", 55),
    ("14 day hiking trip to Kilimanjaro, Tanzania", 1313),
    ("A week in Cambodia", 2121),
    ("5 day cruise to Alaska", 555),
    ("14 day hiking trip to Kilimanjaro, Tanzania", 12313),
    ("A week in Cambodia", 29),
    ("5 day cruise to Alaska", 23456),
    ("14 day hiking trip to Kilimanjaro, Tanzania", 12345),
    ("A week in Cambodia", 4567),
    ("5 day cruise to Alaska", 444),
    ("14 day hiking trip to Kilimanjaro, Tanzania", 333),
    ("A week in Cambodia", 222),
)

# Test-data tag vocabulary for posts (covers every language rule, a
# JavaScript tag that the Java rule catches, and two tags with no rule).
POST_TAGS: tuple[str, ...] = (
    "Python-3.x", "node.js", "JavaScript", "ruby-on-rails", "c#", "C++",
    "mysql", "css3", "html5", "react-native", "go", "haskell",
)

ENTRY_PAYLOAD_FIELDS = ("email", "name", "entry_time", "day", "participationnumber")


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  The tables are read-only, so the schema read from the
    Parquet footer once is reused (no schema-inference job per read)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def new_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries before numbering: ``email, name, entry_time, day, ts, event_id``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    named = ev.select(
        "event_id", "ts",
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("name"),
        epoch_seconds("ts").alias("entry_time"),
        day_key("ts").alias("day"),
    )
    return named.select(email_from_name("name").alias("email"), "name", "entry_time", "day",
                        "ts", "event_id")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``email, name, entry_time (double), day, participation_number, event_id``."""
    numbered = assign_numbers(new_entries(spark, sf_dir), "day", ["ts", "event_id"],
                              out_col="participation_number")
    return numbered.select("email", "name", "entry_time", "day", "participation_number",
                           "event_id")


_RECORDS_WRITTEN: dict[tuple[str, str], str] = {}


def entries_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entry records as a topic carries them: ``key, value`` strings.

    A topic is stored: the records are numbered and written once per session and
    source, and read back by whoever consumes them.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _RECORDS_WRITTEN:
        e = entries(spark, sf_dir).withColumnRenamed("participation_number", "participationnumber")
        path = scratch_path(spark, "tables", "entry_records")
        to_records(e, entry_key("day", "participationnumber"), ENTRY_PAYLOAD_FIELDS).write.parquet(path)
        _RECORDS_WRITTEN[key] = path
    return spark.read.schema(KV_SCHEMA).parquet(_RECORDS_WRITTEN[key])


def promotion_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("ts")
    return ev.select(day_key("ts").alias("day")).where(F.col("day").isNotNull()).distinct()


_PROMOTIONS_WRITTEN: dict[tuple[str, str], str] = {}


def promotions(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """``day, promotion, participation_number``: each day x the fixed offers.

    Built by exploding the offer list per day (no join).  With
    ``materialize`` the rows are written to the shared scratch folder once
    per session (the promotions are a stored dimension table, filled by their
    own daily job) and read back, so the planner sees the true file size and
    broadcasts the table by its own size check.
    """
    offers = F.array(*[F.struct(F.lit(p).alias("promotion"), F.lit(n).cast("long").alias("n"))
                       for p, n in PROMOTION_OFFERS])
    df = (promotion_days(spark, sf_dir)
          .select("day", F.explode(offers).alias("o"))
          .select("day", F.col("o.promotion").alias("promotion"),
                  F.col("o.n").alias("participation_number")))
    if not materialize:
        return df
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _PROMOTIONS_WRITTEN:
        _PROMOTIONS_WRITTEN[key] = write_small_table(df, "promotions")
    return spark.read.schema(df.schema).parquet(_PROMOTIONS_WRITTEN[key])


def write_small_table(df: DataFrame, name: str) -> str:
    """Write a small derived table under the scratch folder; return its path."""
    path = scratch_path(df.sparkSession, "tables", name)
    df.write.mode("overwrite").parquet(path)
    return path


def daily_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The promotions as a daily-winners table: ``day date, winnernumber bigint``."""
    p = promotions(spark, sf_dir)
    return p.select(F.to_date("day", "yyyyMMdd").alias("day"),
                    F.col("participation_number").alias("winnernumber"))


def _title(custkey: str, status: str) -> F.Column:
    return F.concat(F.lit("order "), F.col(custkey).cast("string"), F.lit(" "), F.col(status))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``title, body, url, view_count, tags``; one post per order.

    Written as one SQL projection (a single planner call instead of one per
    literal and function)."""
    vocab = "array(" + ", ".join("'" + t.replace("'", "\\'") + "'" for t in POST_TAGS) + ")"
    tags = (f"CASE WHEN o_orderkey % 25 = 0 THEN CAST(NULL AS array<string>) "
            f"WHEN o_orderkey % 25 = 12 THEN CAST(array() AS array<string>) "
            f"ELSE array(element_at({vocab}, CAST(o_orderkey % 12 + 1 AS INT)), "
            f"element_at({vocab}, CAST(o_orderkey % 7 + 1 AS INT))) END")
    return table(spark, sf_dir, "orders").selectExpr(
        "concat('order ', CAST(o_custkey AS STRING), ' ', o_orderstatus) AS title",
        "o_orderpriority AS body",
        "concat('http://q/', CAST(o_orderkey AS STRING)) AS url",
        "CAST(floor(o_totalprice) AS BIGINT) AS view_count",
        f"{tags} AS tags",
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("id"),
                    _title("o_custkey", "o_orderstatus").alias("title"),
                    F.col("o_orderdate").alias("creation_date"),
                    F.col("o_custkey").alias("owner_user_id"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("parent_id"),
                     F.col("l_shipdate").alias("creation_date"),
                     F.col("l_partkey").alias("owner_user_id"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"),
                    F.date_add(F.lit("1995-01-01").cast("date"),
                               (F.col("c_custkey") % 2400).cast("int")).alias("creation_date"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views ``entries, entries_kv, promotions, posts, questions, answers, users``."""
    for name, fn in (("entries", entries), ("entries_kv", entries_kv),
                     ("promotions", promotions), ("posts", posts), ("questions", questions),
                     ("answers", answers), ("users", users)):
        fn(spark, sf_dir).createOrReplaceTempView(name)
