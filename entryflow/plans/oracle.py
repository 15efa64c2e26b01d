"""DuckDB SQL for each registered query, over the driver's raw tables.

The views of ``entryflow.sources.driver_tables`` are restated as CTEs.  The
reports are written from their definitions (existence as EXISTS, a language
as a property that a question has or not, a running total as a count of what
came before), not from the Spark plans, so the oracle checks those plans
rather than repeating them.
"""

from __future__ import annotations

from entryflow.functions.classify import LANGUAGE_RULES, NO_LANGUAGE
from entryflow.sources.driver_tables import POST_TAGS, PROMOTION_OFFERS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(col: str) -> str:
    whens = " ".join(f"WHEN lower({col}) LIKE {_q('%' + kw + '%')} THEN {_q(label)}"
                     for kw, label in LANGUAGE_RULES)
    return f"CASE {whens} ELSE {_q(NO_LANGUAGE)} END"


_TAG_LIST = "[" + ", ".join(_q(t) for t in POST_TAGS) + "]"
_OFFERS = ", ".join(f"({_q(p)}, {n})" for p, n in PROMOTION_OFFERS)

VIEWS = {
    "entries": """
entries AS (
  SELECT lower(regexp_replace('User ' || user_id, '\\s', '', 'g')) || '@mail.com' AS email,
         'User ' || user_id AS name,
         epoch_us(ts) / 1e6 AS entry_time,
         printf('%d.%06d0', epoch_us(ts) // 1000000, epoch_us(ts) % 1000000) AS entry_time_text,
         strftime(ts, '%Y%m%d') AS day,
         CAST(row_number() OVER (PARTITION BY strftime(ts, '%Y%m%d') ORDER BY ts, event_id) - 1
              AS BIGINT) AS participation_number,
         event_id, ts
  FROM events)""",
    "promotions": f"""
promotions AS (
  SELECT d.day, o.promotion, CAST(o.n AS BIGINT) AS participation_number
  FROM (SELECT DISTINCT strftime(ts, '%Y%m%d') AS day FROM events WHERE ts IS NOT NULL) d,
       (VALUES {_OFFERS}) AS o(promotion, n))""",
    "posts": f"""
posts AS (
  SELECT 'order ' || o_custkey || ' ' || o_orderstatus AS title,
         o_orderpriority AS body,
         'http://q/' || o_orderkey AS url,
         CAST(floor(o_totalprice) AS BIGINT) AS view_count,
         CASE WHEN o_orderkey % 25 = 0 THEN NULL
              WHEN o_orderkey % 25 = 12 THEN CAST([] AS VARCHAR[])
              ELSE [{_TAG_LIST}[CAST(o_orderkey % 12 + 1 AS INTEGER)],
                    {_TAG_LIST}[CAST(o_orderkey % 7 + 1 AS INTEGER)]] END AS tags
  FROM orders)""",
    "questions": """
questions AS (
  SELECT o_orderkey AS id, 'order ' || o_custkey || ' ' || o_orderstatus AS title,
         o_orderdate AS creation_date, o_custkey AS owner_user_id
  FROM orders)""",
    "answers": """
answers AS (
  SELECT l_orderkey AS parent_id, l_shipdate AS creation_date, l_partkey AS owner_user_id
  FROM lineitem)""",
    "users": """
users AS (
  SELECT c_custkey AS id, CAST(DATE '1995-01-01' + CAST(c_custkey % 2400 AS INTEGER) AS DATE)
         AS creation_date
  FROM customer)""",
}


def with_views(body: str, *names: str) -> str:
    return "WITH " + ",".join(VIEWS[n] for n in names) + "\n" + body


LANG_CASE = _case("tag")

_LABELS = ", ".join(f"({_q(label)})" for label in dict.fromkeys(label for _, label in LANGUAGE_RULES))

# A question has a language when some post with its title has a tag of that language.
DAYS_TO_ANSWER_INNER = f"""
SELECT q.id, l.label AS programming_language, min(q.creation_date) AS post_date,
       min(f.answered) AS answer_date,
       date_diff('day', min(q.creation_date), min(f.answered)) AS days
FROM questions q
JOIN (SELECT parent_id, min(creation_date) AS answered FROM answers GROUP BY parent_id) f
  ON f.parent_id = q.id
CROSS JOIN (VALUES {_LABELS}) l(label)
WHERE EXISTS (SELECT 1 FROM (SELECT title, {_case('tag')} AS label
                             FROM (SELECT title, unnest(tags) AS tag FROM posts)) t
              WHERE t.title = q.title AND t.label = l.label)
GROUP BY q.id, l.label
HAVING date_diff('day', min(q.creation_date), min(f.answered)) >= 0"""

# Who asked, or answered, a question whose title a post has.
ACTIVE_PAIRS = """
SELECT DISTINCT CAST(year(done.at) AS BIGINT) AS year, done.user_id
FROM (SELECT title, owner_user_id AS user_id, CAST(creation_date AS TIMESTAMP) AS at FROM questions
      UNION ALL
      SELECT q.title, a.owner_user_id, CAST(a.creation_date AS TIMESTAMP)
      FROM answers a, questions q WHERE a.parent_id = q.id) done
WHERE EXISTS (SELECT 1 FROM posts p WHERE p.title = done.title)
  AND EXISTS (SELECT 1 FROM users u WHERE u.id = done.user_id)"""

# Users without a date come first.
USERS_TOTALS = """
SELECT y.year,
       count(u.id) FILTER (year(u.creation_date) IS NOT DISTINCT FROM y.year) AS number_of_users,
       count(u.id) AS total_users
FROM (SELECT DISTINCT CAST(year(creation_date) AS BIGINT) AS year FROM users) y
JOIN users u ON u.creation_date IS NULL OR year(u.creation_date) <= y.year
GROUP BY y.year"""

ACTIVE_VS_TOTAL = f"""
SELECT act.year, act.active_users, tot.total_users
FROM (SELECT year, COUNT(user_id) AS active_users FROM ({ACTIVE_PAIRS}) GROUP BY year) act
JOIN ({USERS_TOTALS}) tot ON act.year = tot.year"""

DAYS_TO_ANSWER = f"""
SELECT programming_language, CAST(EXTRACT(YEAR FROM post_date) AS BIGINT) AS year,
       AVG(days) AS average_number_of_days_for_answer
FROM ({DAYS_TO_ANSWER_INNER})
GROUP BY 1, 2"""

QA = ("posts", "questions", "answers", "users")

SQL: dict[str, str] = {
    # -- raffle entries --------------------------------------------------
    "entries_parsed": with_views("""
SELECT email, name, entry_time_text AS entry_time, day, participation_number
FROM entries""", "entries"),
    "winners_inner": with_views("""
SELECT e.email, e.name, e.entry_time_text AS entry_time, e.day, e.participation_number,
       p.promotion
FROM entries e JOIN promotions p
  ON e.day = p.day AND e.participation_number = p.participation_number""",
                                "entries", "promotions"),
    "flagged_entries": with_views("""
SELECT e.entry_time, (p.day IS NOT NULL) AS winner, e.name,
       CAST(e.participation_number AS DOUBLE) AS participationnumber, e.day, e.email
FROM entries e LEFT JOIN promotions p
  ON e.day || '_' || e.participation_number = p.day || '_' || p.participation_number""",
                                  "entries", "promotions"),
    "flagged_records": with_views("""
SELECT e.day || '_' || e.participation_number AS key, e.email, e.name, e.entry_time, e.day,
       e.participation_number AS participationnumber, (p.day IS NOT NULL) AS winner
FROM entries e LEFT JOIN promotions p
  ON e.day = p.day AND e.participation_number = p.participation_number""",
                                  "entries", "promotions"),
    "cogroup_counts": with_views("""
SELECT coalesce(e.key, p.key) AS key, coalesce(e.n, 0) AS n_entries,
       coalesce(p.n, 0) AS n_promotions
FROM (SELECT day || '_' || participation_number AS key, COUNT(*) AS n FROM entries GROUP BY 1) e
FULL OUTER JOIN
     (SELECT day || '_' || participation_number AS key, COUNT(*) AS n FROM promotions GROUP BY 1) p
  ON e.key = p.key""", "entries", "promotions"),
    "unique_promotions": with_views("""
SELECT day, min(promotion) AS promotion, participation_number
FROM promotions GROUP BY day, participation_number""", "promotions"),
    "promotions_for_day": with_views("""
SELECT day || '_' || participation_number AS key,
       CAST(strptime(day, '%Y%m%d') AS DATE) AS day, participation_number AS winnernumber
FROM promotions WHERE day = '20240115'""", "promotions"),
    "assign_numbers": with_views("""
SELECT event_id, day, participation_number FROM entries""", "entries"),
    "day_keys": """
SELECT d AS day, strftime(d, '%Y%m%d') AS calendar_key, strftime(d, '%G%m%d') AS iso_key,
       replace(CAST(d AS VARCHAR), '-', '') AS stripped, CAST(n AS BIGINT) AS events
FROM (SELECT CAST(ts AS DATE) AS d, COUNT(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1)""",
    # -- question-and-answer reports --------------------------------------
    "top_viewed": with_views("""
SELECT DISTINCT title, body, url, view_count FROM posts
ORDER BY view_count DESC NULLS LAST, title, url, body LIMIT 10""", "posts"),
    "posts_by_language": with_views(f"""
SELECT programming_language, COUNT(*) AS total_num_of_posts
FROM (SELECT {LANG_CASE} AS programming_language
      FROM (SELECT DISTINCT title, tag FROM (SELECT title, unnest(tags) AS tag FROM posts)))
WHERE programming_language <> 'NA'
GROUP BY programming_language""", "posts"),
    "days_to_answer": with_views(DAYS_TO_ANSWER, *QA),
    "active_vs_total": with_views(ACTIVE_VS_TOTAL, *QA),
    "tag_unnest": with_views("""
SELECT url, unnest(tags) AS tag FROM posts""", "posts"),
    "classify_tags": with_views(f"""
SELECT url, tag, {LANG_CASE} AS programming_language
FROM (SELECT url, unnest(tags) AS tag FROM posts)""", "posts"),
    "union_distinct_users": with_views(ACTIVE_PAIRS, *QA),
    "running_total_users": with_views(USERS_TOTALS, "users"),
    "language_rollup": with_views(f"""
SELECT programming_language,
       CAST(SUM(average_number_of_days_for_answer) AS DECIMAL(38,6)) AS sum_average_days
FROM ({DAYS_TO_ANSWER}) GROUP BY 1""", *QA),
    "yearly_answer_days": with_views(f"""
SELECT year, CAST(SUM(average_number_of_days_for_answer) AS DECIMAL(38,6)) AS sum_average_days
FROM ({DAYS_TO_ANSWER}) GROUP BY 1""", *QA),
    "yearly_active": with_views(f"""
SELECT year, active_users FROM ({ACTIVE_VS_TOTAL})""", *QA),
    "user_share": with_views(f"""
SELECT year, active_users, total_users,
       CAST(active_users AS DOUBLE) / (active_users + total_users) AS active_users_share,
       CAST(total_users AS DOUBLE) / (active_users + total_users) AS total_users_share
FROM ({ACTIVE_VS_TOTAL})""", *QA),
}

# Streaming runs produce the same rows as their batch twins.
SQL["entries_stream"] = SQL["entries_parsed"]
SQL["winners_stream"] = SQL["winners_inner"]
SQL["flagged_stream"] = SQL["flagged_entries"]
SQL["transcode_posts"] = with_views("SELECT title, body, url, view_count, tags FROM posts", "posts")
SQL["assign_numbers_split"] = SQL["assign_numbers"]
SQL["produce_records"] = with_views("""
SELECT day || '_' || participation_number AS key, email, name, entry_time, day,
       participation_number AS participationnumber
FROM entries""", "entries")
SQL["numbered_stream"] = """
SELECT strftime(ts, '%Y%m%d') AS day, COUNT(*) AS rows, CAST(0 AS BIGINT) AS min_n,
       CAST(COUNT(*) - 1 AS BIGINT) AS max_n, COUNT(*) AS distinct_n
FROM events GROUP BY 1"""

SQL["record_count_by_year"] = with_views(f"""
SELECT year, COUNT(*) AS record_count FROM ({DAYS_TO_ANSWER}) GROUP BY year""", *QA)

SQL["entries_into_table"] = SQL["synced_table"] = SQL["entries_parsed"]
SQL["winners_into_table"] = SQL["winners_inner"]
SQL["flagged_into_table"] = SQL["flagged_entries"]
SQL["flagged_topic_stream"] = SQL["flagged_records"]
SQL["records_round_trip"] = SQL["produce_records"]
SQL["inserted_promotions"] = with_views(f"""
SELECT day, promotion, participation_number FROM promotions
UNION ALL
SELECT '20310102', o.promotion, CAST(o.n AS BIGINT) FROM (VALUES {_OFFERS}) AS o(promotion, n)""",
                                        "promotions")
# every writer adds all rows
for _name in ("mixed_writers_batch_first", "mixed_writers_stream_first", "mixed_writers_dead_letters",
              "compacted_entries"):
    SQL[_name] = f"SELECT * FROM ({SQL['entries_parsed']}), (VALUES (1), (2)) AS twice(n)".replace(
        "SELECT *", "SELECT email, name, entry_time, day, participation_number", 1)
SQL["mixed_writers_refresh"] = (
    "SELECT email, name, entry_time, day, participation_number, promotion "
    f"FROM ({SQL['winners_inner']}), (VALUES (1), (2)) AS twice(n)")
SQL["records_once"] = SQL["records_once_stream"] = SQL["flagged_records"]
SQL["days_to_answer_bucketed"] = SQL["days_to_answer"]
SQL["active_vs_total_bucketed"] = SQL["active_vs_total"]
SQL["cogroup_stream"] = SQL["cogroup_counts"]
SQL["unique_entries_stream"] = SQL["flagged_entries"]
SQL["json_fields_kept"] = """
SELECT CAST(event_id AS VARCHAR) AS key, event_id % 10 <> 3 AS kept,
       CASE WHEN event_id % 10 = 3 THEN 'not json'
            ELSE '{"id":' || event_id || ',"score":' || event_id || '.25,"inner":{"list":['
                 || event_id || ',null],"name":"x"},"winner":true}' END AS value
FROM events"""
SQL["preview"] = SQL["winners_inner"] + """
ORDER BY e.day NULLS FIRST, e.participation_number NULLS FIRST, p.promotion LIMIT 100"""
SQL["preview_entries"] = SQL["entries_parsed"] + """
ORDER BY day NULLS FIRST, participation_number NULLS FIRST LIMIT 100"""
SQL["preview_promotions"] = with_views("""
SELECT day, promotion, participation_number FROM promotions
ORDER BY day, participation_number, promotion LIMIT 100""", "promotions")

# The SQL-API versions of the reports give the same rows.
for _name in ("top_viewed", "posts_by_language", "days_to_answer", "active_vs_total"):
    SQL[f"{_name}_sql"] = SQL[_name]
