"""Reports over question-and-answer posts.

Inputs (any frames with these columns):
    posts(title, body, url, view_count, tags array<string>)
    questions(id, title, creation_date, owner_user_id)
    answers(parent_id, creation_date, owner_user_id)
    users(id, creation_date)

Each report returns the same rows as the SQL it is modelled on, but the plan
is arranged for volume: distinct / pre-aggregation before joins, semi joins
where only existence matters, and no join that fans out over a shared title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from entryflow.functions.classify import LANGUAGE_RULES, NO_LANGUAGE, classify
from entryflow.operators.ranking import running_total, top_distinct
from entryflow.sinks.bucketed import SLOT

LANG = "programming_language"

#: Languages that a row of ``title_languages`` holds.
WORD_BITS = 63

#: Rows of a title that a semi join against titles sees at most.
TITLE_COPIES = 8


def tag_rows(posts: DataFrame, *cols: str) -> DataFrame:
    """One row per (post, tag); posts with NULL or empty tags give none."""
    return posts.select(*cols, F.explode("tags").alias("tag"))


def label_tags(posts: DataFrame, rules=LANGUAGE_RULES) -> DataFrame:
    """``title, tag, programming_language`` for every tag of every post."""
    return tag_rows(posts, "title").withColumn(LANG, classify("tag", rules))


def top_viewed(posts: DataFrame, k: int = 10) -> DataFrame:
    """The k most viewed distinct (title, body, url, view_count) rows.

    Ties on view_count are broken by title, url, body so the result is fixed.
    """
    return top_distinct(posts, ["title", "body", "url", "view_count"], "view_count", k,
                        tie_breakers=["title", "url", "body"])


def posts_by_language(posts: DataFrame, rules=LANGUAGE_RULES) -> DataFrame:
    """Distinct (title, tag) pairs per language label, most first.

    A post tagged ``python`` and ``python-3.x`` counts twice for Python, as
    in the original report (the distinct is over (title, tag)).  The NA
    filter runs before the distinct, which is the same since the label is a
    function of the tag.
    """
    labelled = label_tags(posts, rules).where(F.col(LANG) != NO_LANGUAGE)
    pairs = labelled.select("title", "tag", LANG).distinct()
    return (pairs.groupBy(LANG).agg(F.count(F.lit(1)).alias("total_num_of_posts"))
                 .orderBy(F.col("total_num_of_posts").desc(), F.col(LANG)))


def labels_of(rules=LANGUAGE_RULES) -> list[str]:
    """The rules' distinct labels, in order; the place of one is its bit in ``title_languages``."""
    return list(dict.fromkeys(label for _, label in rules if label != NO_LANGUAGE))


def title_languages(posts: DataFrame, rules=LANGUAGE_RULES) -> DataFrame:
    """``title, word, langs``: the languages of a title's tags, as bits.

    One row a title (and one for each further ``WORD_BITS`` labels, told apart by ``word``), however
    many posts share the title, built with a map-side partial step.  The rows are partitioned by
    more than the title, so a join on title shuffles both of its sides, and a hot title is a skewed
    key that AQE splits.
    """
    bit, word = F.lit(None).cast("long"), F.lit(0)
    for i, label in reversed(list(enumerate(labels_of(rules)))):
        this = F.col(LANG) == label
        bit = F.when(this, F.lit(1 << i % WORD_BITS).cast("long")).otherwise(bit)
        word = F.when(this, F.lit(i // WORD_BITS)).otherwise(word)
    return (label_tags(posts, rules).where((F.col(LANG) != NO_LANGUAGE) & F.col("title").isNotNull())
            .groupBy("title", F.xxhash64("title").alias("spread"), word.alias("word"))
            .agg(F.bit_or(bit).alias("langs")).select("title", "word", "langs"))


def _question_keys(questions: DataFrame, answers: DataFrame) -> tuple[list[str], list[str]]:
    """Columns of both that name a question: its id, and in tables stored by question its slot."""
    slot = [SLOT] if SLOT in questions.columns and SLOT in answers.columns else []
    return ["id", *slot], ["parent_id", *slot]


def first_answer_days(posts: DataFrame, questions: DataFrame, answers: DataFrame,
                      rules=LANGUAGE_RULES, buckets: int | None = None) -> DataFrame:
    """Per (question id, language): first post date, first answer date, and
    the calendar days between them (only pairs with days >= 0).

    Equals grouping the join posts x questions (on title) x answers (on id)
    x unnested tags by (id, language), because MIN ignores repeats: the
    posts are reduced to the languages of each title and the answers to
    their first date per question before they are joined, so no join
    multiplies rows over a shared title or a question's answers.

    A question's languages stay one row, as bits, until the days are known. Of
    several rows of an id, in order of date, each keeps the languages that are new:
    a running OR over rows that the join sorts by id anyway, so no task holds a table
    of its ids.

    Of tables stored by question (``sinks.bucketed``), the answers are reduced
    and joined where they lie; give their number of buckets as ``buckets``.
    """
    langs = title_languages(posts, rules)
    ids, parents = _question_keys(questions, answers)
    # without a date there are no days
    q = (questions.select(*ids, "title", F.col("creation_date").alias("post_date"))
         .where(F.col("id").isNotNull() & F.col("post_date").isNotNull()))
    # partitioned and sorted by id once, for the running OR and the join with the
    # first answers (keyed by question id)
    per_q = q.join(langs, "title", "inner").select(*ids, "word", "post_date", "langs")
    per_q = per_q.repartition(buckets, *ids) if buckets else per_q.repartition(*ids)
    before = (Window.partitionBy(*ids, "word").orderBy("post_date", "langs")
              .rowsBetween(Window.unboundedPreceding, -1))
    seen = F.coalesce(F.bit_or("langs").over(before), F.lit(0).cast("long"))
    per_q = (per_q.withColumn("langs", F.col("langs").bitwiseAND(F.bitwise_not(seen)))
             .where(F.col("langs") != 0))
    first_answer = (answers.where(F.col("parent_id").isNotNull())
                    .groupBy(*[F.col(c).alias(f"_{c}") for c in parents])
                    .agg(F.min("creation_date").alias("answer_date")))
    same = [per_q[i] == first_answer[f"_{p}"] for i, p in zip(ids, parents)]
    per_q = per_q.join(first_answer, same, "inner").drop(*[f"_{p}" for p in parents])
    if SLOT in ids:
        # the rows of a question are the same in all of its slots
        per_q = per_q.groupBy("id", "word", "post_date", "langs").agg(F.min("answer_date").alias("answer_date"))
    days = F.datediff(F.col("answer_date"), F.col("post_date"))
    named = [F.when((F.col("word") == i // WORD_BITS)
                    & (F.col("langs").bitwiseAND(F.lit(1 << i % WORD_BITS).cast("long")) != 0), F.lit(label))
             for i, label in enumerate(labels_of(rules))]
    return (per_q.withColumn("days", days).where(F.col("days") >= 0)
            .withColumn(LANG, F.explode(F.array_compact(F.array(*named).cast("array<string>"))))
            .select("id", LANG, "post_date", "answer_date", "days"))


def days_to_answer(posts: DataFrame, questions: DataFrame, answers: DataFrame,
                   rules=LANGUAGE_RULES, buckets: int | None = None) -> DataFrame:
    """Mean calendar days from question to first answer, by language and year."""
    per_q = first_answer_days(posts, questions, answers, rules, buckets)
    return (per_q.groupBy(LANG, F.year("post_date").cast("long").alias("year"))
                 .agg(F.avg("days").alias("average_number_of_days_for_answer"))
                 .orderBy(LANG, "year", "average_number_of_days_for_answer"))


def active_user_years(posts: DataFrame, questions: DataFrame, answers: DataFrame,
                      users: DataFrame) -> DataFrame:
    """Distinct (year, user_id) of known users who asked a question whose
    title appears in posts, or answered one.

    Only existence matters, so posts, questions and users enter through
    left-semi joins.  No aggregate stands between a semi join on title or
    question id and its shuffles, so that AQE can split a hot title and a
    question with very many answers; the titles are reduced before, to at
    most ``TITLE_COPIES`` rows each.  The union of the two (year, user) sets
    is deduplicated per user, as a set of years, in the same shuffle that the
    semi join with users uses.
    """
    part = F.pmod(F.xxhash64("url"), F.lit(TITLE_COPIES))
    titles = (posts.where(F.col("title").isNotNull())
              .select("title", part.alias("part")).distinct().select("title"))
    asked = questions.join(titles, "title", "left_semi")
    q_years = asked.select(F.year("creation_date").cast("long").alias("year"),
                           F.col("owner_user_id").alias("user_id"))
    ids, parents = _question_keys(questions, answers)
    asked_ids = asked.select(*[F.col(c).alias(f"_{c}") for c in ids]).where(F.col("_id").isNotNull())
    same = [answers[p] == asked_ids[f"_{i}"] for p, i in zip(parents, ids)]
    answered = answers.join(asked_ids, same, "left_semi")
    a_years = answered.select(F.year("creation_date").cast("long").alias("year"),
                              F.col("owner_user_id").alias("user_id"))
    # one shuffle keyed by user: each user's set of active years (at most one
    # entry per distinct year, reduced map-side) is both the DISTINCT and the
    # input of the semi join on user id, which reuses its partitioning
    per_user = (q_years.unionByName(a_years).where(F.col("user_id").isNotNull())
                .groupBy("user_id").agg(F.collect_set(F.struct("year")).alias("years")))
    known = users.select(F.col("id").alias("user_id")).where(F.col("user_id").isNotNull()).distinct()
    return (per_user.join(known, "user_id", "left_semi")
            .select(F.explode("years").alias("y"), "user_id")
            .select(F.col("y.year").alias("year"), "user_id"))


def users_running_total(users: DataFrame) -> DataFrame:
    """``year, number_of_users, total_users``: new users per year and the
    running total over years (peers included)."""
    per_year = users.groupBy(F.year("creation_date").cast("long").alias("year")) \
        .agg(F.count("id").alias("number_of_users"))
    totals = running_total(per_year, "year", "number_of_users", "total_users",
                           one_row_per_value=True)
    return totals.select("year", "number_of_users",
                         F.col("total_users").cast("long").alias("total_users"))


def active_vs_total(posts: DataFrame, questions: DataFrame, answers: DataFrame,
                    users: DataFrame) -> DataFrame:
    """``year, active_users, total_users`` for years present on both sides."""
    active = (active_user_years(posts, questions, answers, users)
              .groupBy("year").agg(F.count("user_id").alias("active_users")))
    totals = users_running_total(users).select("year", "total_users")
    return active.join(totals, "year").select("year", "active_users", "total_users") \
                 .orderBy("year")
