"""The four reports as Spark SQL over temp views.

For users who keep their reports as SQL text: register the tables as views
(``posts, questions, answers, users``) and run ``spark.sql(REPORTS[name])``.
The statements follow the same plan shapes as ``plans.reports`` (distinct and
first-date reductions before joins, LEFT SEMI joins for existence, a
threshold filter before the top-k DISTINCT), so Catalyst gets the same
logical plans from either API.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from entryflow.functions.classify import classify_sql as language_case
from entryflow.plans.reports import TITLE_COPIES, labels_of


_TAGS = f"""
  SELECT title, {language_case('tag')} AS programming_language
  FROM posts LATERAL VIEW explode(tags) t AS tag"""

# A title's languages are bits of one number, as in ``reports.title_languages``.
_BIT = "CASE programming_language " + " ".join(
    f"WHEN '{label}' THEN {1 << i}L" for i, label in enumerate(labels_of())) + " END"
_NAMES = ", ".join(f"CASE WHEN langs & {1 << i}L <> 0 THEN '{label}' END" for i, label in enumerate(labels_of()))

REPORTS: dict[str, str] = {
    "top_viewed": """
WITH near_top AS (
  SELECT title, body, url, view_count FROM posts
  WHERE view_count >= (SELECT min(view_count)
                       FROM (SELECT DISTINCT view_count FROM posts
                             WHERE view_count IS NOT NULL
                             ORDER BY view_count DESC LIMIT 10))
     OR view_count IS NULL)
SELECT DISTINCT title, body, url, view_count FROM near_top
ORDER BY view_count DESC NULLS LAST, title, url, body
LIMIT 10""",
    "posts_by_language": f"""
SELECT programming_language, count(1) AS total_num_of_posts
FROM (SELECT DISTINCT title, tag, {language_case('tag')} AS programming_language
      FROM posts LATERAL VIEW explode(tags) t AS tag)
WHERE programming_language <> 'NA'
GROUP BY programming_language
ORDER BY total_num_of_posts DESC, programming_language""",
    "days_to_answer": f"""
WITH langs AS (
  SELECT title, bit_or({_BIT}) AS langs FROM ({_TAGS})
  WHERE programming_language <> 'NA' AND title IS NOT NULL
  GROUP BY title, xxhash64(title)),
per_q AS (
  SELECT id, post_date, langs & ~coalesce(bit_or(langs) OVER (
           PARTITION BY id ORDER BY post_date, langs
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS langs
  FROM (SELECT /*+ REPARTITION(id) */ q.id, q.creation_date AS post_date, l.langs
        FROM questions q JOIN langs l ON q.title = l.title
        WHERE q.id IS NOT NULL AND q.creation_date IS NOT NULL)),
first_answer AS (
  SELECT parent_id, min(creation_date) AS answer_date
  FROM answers WHERE parent_id IS NOT NULL GROUP BY parent_id),
days AS (
  SELECT p.langs, p.post_date, datediff(f.answer_date, p.post_date) AS days
  FROM (SELECT * FROM per_q WHERE langs <> 0) p JOIN first_answer f ON p.id = f.parent_id)
SELECT programming_language, CAST(year(post_date) AS BIGINT) AS year,
       avg(days) AS average_number_of_days_for_answer
FROM days LATERAL VIEW explode(array_compact(array({_NAMES}))) t AS programming_language
WHERE days >= 0
GROUP BY programming_language, year(post_date)
ORDER BY programming_language, year, average_number_of_days_for_answer""",
    "active_vs_total": f"""
WITH titles AS (
  SELECT title FROM (SELECT DISTINCT title, pmod(xxhash64(url), {TITLE_COPIES}L) AS part
                     FROM posts WHERE title IS NOT NULL)),
asked AS (SELECT * FROM questions q LEFT SEMI JOIN titles t ON q.title = t.title),
asked_ids AS (SELECT id FROM asked WHERE id IS NOT NULL),
per_user AS (
  SELECT user_id, collect_set(struct(year)) AS years
  FROM (SELECT CAST(year(creation_date) AS BIGINT) AS year, owner_user_id AS user_id FROM asked
        UNION ALL
        SELECT CAST(year(a.creation_date) AS BIGINT) AS year, a.owner_user_id AS user_id
        FROM answers a LEFT SEMI JOIN asked_ids i ON a.parent_id = i.id)
  WHERE user_id IS NOT NULL
  GROUP BY user_id),
known AS (SELECT DISTINCT id FROM users WHERE id IS NOT NULL),
active AS (
  SELECT y.year AS year, count(user_id) AS active_users
  FROM (SELECT * FROM per_user p LEFT SEMI JOIN known k ON p.user_id = k.id)
  LATERAL VIEW explode(years) t AS y
  GROUP BY y.year),
totals AS (
  SELECT year, CAST(sum(n) OVER (ORDER BY year) AS BIGINT) AS total_users
  FROM (SELECT CAST(year(creation_date) AS BIGINT) AS year, count(id) AS n
        FROM users GROUP BY 1))
SELECT a.year, a.active_users, t.total_users
FROM active a JOIN totals t ON a.year = t.year
ORDER BY a.year""",
}


VIEWS = ("posts", "questions", "answers", "users")


def report_sql(name: str, prefix: str = "") -> str:
    """The statement, over views whose names begin with ``prefix``."""
    return re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(VIEWS)})\b", rf"\1\2{prefix}\3", REPORTS[name])


def run_report(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    """Run one report over the views already registered in ``spark``."""
    return spark.sql(report_sql(name, prefix))


def register_report_views(spark: SparkSession, posts: DataFrame, questions: DataFrame,
                          answers: DataFrame, users: DataFrame, prefix: str = "") -> None:
    """Register the tables as temp views ``<prefix>posts`` and so on (a view of
    that name is replaced)."""
    for view, df in zip(VIEWS, (posts, questions, answers, users)):
        df.createOrReplaceTempView(prefix + view)
