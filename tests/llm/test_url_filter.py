import pytest

from entryflow.llm.url_filter import MAX_RULES, UrlTrie, judge_urls, parse_rule, split_url

RULES = [parse_rule("block", "net/"), parse_rule("allow", "example.net/en/"),
         parse_rule("block", "example.com/de/"), parse_rule("allow", "org/fr/")]


@pytest.mark.parametrize("url, parts", [
    (None, ("", "")), ("", ("", "")), ("no-scheme.net/x", ("", "")),
    ("http://A.Net", ("a.net", "")), ("http://a.net?x=/y", ("a.net", "")),
    ("http://a.net/p/q?x#y", ("a.net", "/p/q")), ("x://h#/p", ("h", "")),
    ("http://ÄB.net/P", ("Äb.net", "/P")), ("a://b://c/d", ("b:", "//c/d")),
])
def test_split(url, parts):
    assert split_url(url) == parts


@pytest.mark.parametrize("host, path, rule", [
    ("net", "/", "net/"), ("a.net", "/x", "net/"), ("a.net", "", None), ("anet", "/", None),
    ("example.net", "/en/", "example.net/en/"), ("m.example.net", "/en/1", "example.net/en/"),
    ("example.net", "/en", "net/"), ("example.net", "/english/", "net/"),
    ("example.com", "/de/1", "example.com/de/"), ("example.com", "/DE/1", None),
    ("xexample.com", "/de/1", None), ("a.org", "/fr/x", "org/fr/"), ("", "", None),
])
def test_longest_match(host, path, rule):
    found = UrlTrie(RULES).lookup(host, path)
    assert (found and found[0]) == rule


def test_partial_segments_and_equal_rules():
    trie = UrlTrie([parse_rule("allow", "a.b/en"), parse_rule("block", "a.b/english"),
                    parse_rule("allow", "c/"), parse_rule("block", "c/")])
    assert trie.lookup("a.b", "/enter") == ("a.b/en", "allow")
    assert trie.lookup("a.b", "/english/x") == ("a.b/english", "block")
    assert trie.lookup("c", "/x") == ("c/", "block")


def test_table_with_nulls_and_extra_columns(spark):
    rows = [(1, "http://a.net/x", "q"), (1, "http://a.net/x", "q"), (2, None, None),
            (None, "http://x.org/fr/", "r")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = sorted(map(tuple, judge_urls(df, RULES).collect()), key=str)
    assert got == sorted([(1, "a.net", "/x", "net/", "block")] * 2
                         + [(2, "", "", None, "allow"), (None, "x.org", "/fr/", "org/fr/", "allow")],
                         key=str)
    assert judge_urls(df.limit(0), RULES, default="block").count() == 0


def test_rule_list_is_bounded(spark):
    df = spark.createDataFrame([(1, "x")], "page_id long, url string")
    with pytest.raises(ValueError):
        judge_urls(df, [RULES[0]] * (MAX_RULES + 1))
