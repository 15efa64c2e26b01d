import datetime as dt

from entryflow.plans import chartdata, reports

POSTS = "title string, body string, url string, view_count long, tags array<string>"
QUESTIONS = "id long, title string, creation_date timestamp_ntz, owner_user_id long"
ANSWERS = "parent_id long, creation_date timestamp_ntz, owner_user_id long"
USERS = "id long, creation_date date"


def D(*a):
    return dt.datetime(*a)


def fixture(spark):
    posts = spark.createDataFrame([
        ("t1", "b", "u1", 10, ["python", "python-3.x", "go"]),
        ("t1", "b", "u1", 10, ["python"]),              # repeated post
        ("t2", "b", "u2", 30, ["JavaScript", "mysql"]),
        ("t3", "b", "u3", 20, None),
        ("t4", "b", "u4", 20, []),
        ("t5", "b", "u5", 5, ["reactive"]),
    ], POSTS)
    questions = spark.createDataFrame([
        (1, "t1", D(2020, 1, 1, 23, 0), 100),
        (2, "t2", D(2020, 6, 1), 101),
        (3, "t2", D(2021, 1, 1), 999),    # owner not a user
        (4, "t9", D(2021, 1, 1), 100),    # title not in posts
        (5, "t5", D(2021, 3, 1), None),
    ], QUESTIONS)
    answers = spark.createDataFrame([
        (1, D(2020, 1, 2, 1, 0), 102),   # 23:00 -> 01:00 next day = 1 day
        (1, D(2020, 1, 5), 103),
        (2, D(2020, 5, 1), 101),         # before the question: dropped
        (3, D(2021, 1, 11), 102),
        (4, D(2021, 1, 2), 104),         # question title not in posts
        (5, D(2021, 3, 3), None),
    ], ANSWERS)
    users = spark.createDataFrame([
        (100, dt.date(2019, 5, 1)), (101, dt.date(2020, 2, 1)), (102, dt.date(2020, 3, 1)),
        (103, dt.date(2021, 1, 1)), (104, dt.date(2021, 7, 1)),
    ], USERS)
    return posts, questions, answers, users


def test_top_viewed(spark):
    posts, *_ = fixture(spark)
    got = [(r.title, r.view_count) for r in reports.top_viewed(posts, 3).collect()]
    assert got == [("t2", 30), ("t3", 20), ("t4", 20)]  # distinct, ties by title
    assert reports.top_viewed(posts, 50).count() == 5   # fewer rows than k


def test_posts_by_language(spark):
    posts, *_ = fixture(spark)
    got = {r.programming_language: r.total_num_of_posts
           for r in reports.posts_by_language(posts).collect()}
    # python and python-3.x count twice for Python (distinct (title, tag)); go is NA
    assert got == {"Python": 2, "Java": 1, "SQL": 1, "React": 1}


def test_days_to_answer(spark):
    posts, q, a, _ = fixture(spark)
    got = {(r.programming_language, r.year): r.average_number_of_days_for_answer
           for r in reports.days_to_answer(posts, q, a).collect()}
    # q1 Python 2020: first answer 1 day; q2 answered before: dropped;
    # q3 (t2: Java, SQL) 2021: 10 days; q5 React 2021: 2 days
    assert got == {("Python", 2020): 1.0, ("Java", 2021): 10.0, ("SQL", 2021): 10.0,
                   ("React", 2021): 2.0}


def test_active_vs_total(spark):
    posts, q, a, u = fixture(spark)
    pairs = sorted(tuple(r) for r in reports.active_user_years(posts, q, a, u).collect())
    assert pairs == [(2020, 100), (2020, 101), (2020, 102), (2020, 103), (2021, 102)]
    got = [tuple(r) for r in reports.active_vs_total(posts, q, a, u).collect()]
    assert got == [(2020, 4, 3), (2021, 1, 5)]


def test_running_total_monotone(spark):
    *_, u = fixture(spark)
    rows = reports.users_running_total(u).orderBy("year").collect()
    totals = [r.total_users for r in rows]
    assert totals == sorted(totals) and totals[-1] == u.count()


def test_chart_data(spark):
    posts, q, a, u = fixture(spark)
    days = reports.days_to_answer(posts, q, a)
    roll = [tuple(r) for r in chartdata.language_rollup(days).collect()]
    assert roll[0] == ("Java", 10.0) and len(roll) == 4
    share = chartdata.user_share(reports.active_vs_total(posts, q, a, u)).collect()
    for r in share:
        assert abs(r.active_users_share + r.total_users_share - 1.0) < 1e-12
    assert [tuple(r) for r in chartdata.record_count(days, "year").collect()] == \
        [(2020, 1), (2021, 3)]
    from entryflow.operators.ranking import rollup_metric
    assert rollup_metric(days, "year", "average_number_of_days_for_answer", "m", "max") \
        .collect()[0].m == 10.0
    assert [tuple(r) for r in chartdata.yearly_active(
        reports.active_vs_total(posts, q, a, u)).collect()] == [(2020, 4), (2021, 1)]


def test_sql_api_matches_dataframe_api(spark):
    from entryflow.plans import sql_reports
    posts, q, a, u = fixture(spark)
    sql_reports.register_report_views(spark, posts, q, a, u)
    pairs = {
        "top_viewed": reports.top_viewed(posts),
        "posts_by_language": reports.posts_by_language(posts),
        "days_to_answer": reports.days_to_answer(posts, q, a),
        "active_vs_total": reports.active_vs_total(posts, q, a, u),
    }
    for name, df in pairs.items():
        got = sql_reports.run_report(spark, name)
        assert got.columns == df.columns, name
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in df.collect()], name


def test_hot_title_skew(spark):
    """One title shared by most questions: results equal the brute-force join."""
    import duckdb
    from pyspark.sql import functions as F
    from entryflow.plans.oracle import DAYS_TO_ANSWER
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    lineitem = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    hot = F.when(F.col("o_orderkey") % 3 != 0, F.lit("hot")).otherwise(
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")))
    posts = orders.select(hot.alias("title"), F.lit("b").alias("body"), F.lit("u").alias("url"),
                          F.lit(1).cast("long").alias("view_count"),
                          F.array(F.lit("python"), F.lit("mysql")).alias("tags"))
    q = orders.select(F.col("o_orderkey").alias("id"), hot.alias("title"),
                      F.col("o_orderdate").alias("creation_date"),
                      F.col("o_custkey").alias("owner_user_id"))
    a = lineitem.select(F.col("l_orderkey").alias("parent_id"),
                        F.col("l_shipdate").alias("creation_date"),
                        F.col("l_partkey").alias("owner_user_id"))
    got = sorted((r[0], r[1], round(r[2], 9)) for r in reports.days_to_answer(posts, q, a).collect())
    con = duckdb.connect()
    for name, df in (("posts", posts), ("questions", q), ("answers", a)):
        con.register(name, df.toPandas())
    exp = sorted((r[0], r[1], round(r[2], 9)) for r in con.sql(DAYS_TO_ANSWER).fetchall())
    assert got == exp and len(got) > 0


def test_top_viewed_null_counts(spark):
    posts = spark.createDataFrame([
        ("a", "b", "u1", None, None), ("b", "b", "u2", 5, None), ("c", "b", "u3", 7, None),
        ("c", "b", "u3", 7, None),
    ], POSTS)
    assert [(r.title, r.view_count) for r in reports.top_viewed(posts, 3).collect()] == \
        [("c", 7), ("b", 5), ("a", None)]  # NULL sorts last but fills the top 3
    assert [r.title for r in reports.top_viewed(posts, 1).collect()] == ["c"]
    only_null = spark.createDataFrame([("a", "b", "u", None, None)], POSTS)
    assert reports.top_viewed(only_null, 2).count() == 1


def test_register_views_and_sql(spark):
    from entryflow.plans import sql_reports
    from entryflow.sources.driver_tables import register_views
    register_views(spark, "/root/testdata/sf0.001")
    counts = {t: spark.sql(f"SELECT count(*) FROM {t}").head()[0]
              for t in ("entries", "entries_kv", "promotions", "posts", "questions", "answers",
                        "users")}
    assert counts["entries"] == counts["entries_kv"] == 1000
    assert counts["posts"] == counts["questions"] == 1500 and counts["answers"] == 6000
    assert counts["promotions"] == 15 * 30
    by_lang = sql_reports.run_report(spark, "posts_by_language").collect()
    assert {r.programming_language for r in by_lang} == {
        "Python", "Node.js", "Java", "Ruby", "C#", "C++", "SQL", "CSS", "HTML", "React"}


def test_active_pairs_keep_null_year(spark):
    posts, q, a, u = fixture(spark)
    q2 = q.unionByName(spark.createDataFrame([(6, "t1", None, 100)], QUESTIONS))
    pairs = sorted(reports.active_user_years(posts, q2, a, u).collect(),
                   key=lambda r: (r.year is not None, r.year or 0, r.user_id))
    assert tuple(pairs[0]) == (None, 100)  # NULL year kept as its own pair, like DISTINCT
    assert len(pairs) == 6


def _days_brute(posts, questions, answers, rules):
    """{(id, language): (first post date, first answer date)} of what is answered on or after it."""
    langs, first, asked = {}, {}, {}
    for title, tags in posts:
        for tag in tags or []:
            label = next((name for word, name in rules if word in tag.lower()), "NA")
            if title is not None and label != "NA":
                langs.setdefault(title, set()).add(label)
    for parent, day in answers:
        if parent is not None and day is not None:
            first[parent] = min(day, first.get(parent, day))
    for qid, title, day in questions:
        for label in langs.get(title, ()):
            if qid in first and day is not None:
                asked[qid, label] = min(day, asked.get((qid, label), day))
    return {k: (day, first[k[0]]) for k, day in asked.items() if first[k[0]] >= day}


def _odd_questions(rules):
    """Repeated and null ids, titles and dates; titles of many languages."""
    import random
    rnd = random.Random(5)
    day = lambda: rnd.choice([None, *(D(2020, 1, d) for d in range(1, 10))])
    posts = [(rnd.choice([None, "a", "b", "c", "d"]), rnd.choices([w for w, _ in rules] + ["zzz"], k=rnd.randint(0, 3)))
             for _ in range(60)]
    questions = [(rnd.choice([None, *range(40)]), rnd.choice([None, "a", "b", "c", "d", "e"]), day()) for _ in range(200)]
    answers = [(rnd.choice([None, *range(45)]), day()) for _ in range(150)]
    return posts, questions, answers


def _first_answer_days(spark, rows, rules):
    posts, questions, answers = rows
    p = spark.createDataFrame([(t, "b", "u", 1, tags) for t, tags in posts], POSTS)
    q = spark.createDataFrame([(i, t, d, 1) for i, t, d in questions], QUESTIONS)
    a = spark.createDataFrame([(i, d, 1) for i, d in answers], ANSWERS)
    got = reports.first_answer_days(p, q, a, rules).collect()
    found = {(r.id, r.programming_language): (r.post_date, r.answer_date) for r in got}
    assert len(found) == len(got)
    return found


def test_repeated_questions_keep_the_first_date_of_each_language(spark):
    rows = _odd_questions(reports.LANGUAGE_RULES)
    want = _days_brute(*rows, reports.LANGUAGE_RULES)
    assert want and _first_answer_days(spark, rows, reports.LANGUAGE_RULES) == want


def test_any_number_of_languages(spark):
    rules = [(f"tag{i:03d}", f"L{i}") for i in range(2 * reports.WORD_BITS + 5)]
    rows = _odd_questions(rules)
    want = _days_brute(*rows, rules)
    assert want and _first_answer_days(spark, rows, rules) == want
    assert _first_answer_days(spark, rows, []) == {}
