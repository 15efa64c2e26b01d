"""URL rules as a broadcast trie over reversed host labels and path segments.

Host labels are walked from the top-level domain down, so a rule for ``net``
covers every host below it. At a host node hang its path rules: a trie over
whole path segments, with the last, possibly partial segment kept as a text
prefix. The deepest host node with a fitting path wins, and among its paths
the longest; an equal rule listed twice with different verdicts blocks.

The trie grows with the rule list alone, whose length is checked against
``MAX_RULES`` before it is broadcast. The scan reads the id and url columns
only, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import ascii_lower, map_rows

#: A trie of this many rules takes a few hundred MB at most.
MAX_RULES = 1_000_000

SCHEMA = "id long, host string, path string, rule string, verdict string"

Rule = tuple[str, str, str]  # verdict, host, path


def parse_rule(verdict: str, text: str) -> Rule:
    """``net/`` or ``example.net/en/`` as (verdict, host, path)."""
    host, slash, path = text.partition("/")
    return verdict, ascii_lower(host), slash + path


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    if not url or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3:]
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, tail = rest[:end], rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return ascii_lower(host), tail[:stop]


class _Node:
    __slots__ = ("next", "ends")

    def __init__(self):
        self.next: dict[str, _Node] = {}
        #: what the rule has after the node: its last, partial segment -> (rule text, verdict)
        self.ends: dict[str, tuple[str, str]] = {}


class UrlTrie:
    """Longest-match lookup of (host, path)."""

    def __init__(self, rules: Iterable[Rule]):
        self.root = _Node()
        self.paths: dict[int, _Node] = {}
        for verdict, host, path in rules:
            node = self.root
            for label in reversed(host.split(".")):
                node = node.next.setdefault(label, _Node())
            node = self.paths.setdefault(id(node), _Node())
            *whole, last = path.split("/")
            for segment in whole:
                node = node.next.setdefault(segment, _Node())
            if last not in node.ends or verdict == "block":
                node.ends[last] = (host + path, verdict)

    def __getstate__(self):
        raise TypeError("broadcast the rule list; each worker builds its trie")

    def lookup(self, host: str, path: str) -> tuple[str, str] | None:
        if not host:
            return None
        nodes, node = [], self.root
        for label in reversed(host.split(".")):
            node = node.next.get(label)
            if node is None:
                break
            nodes.append(node)
        for node in reversed(nodes):
            tree = self.paths.get(id(node))
            found = tree and self._path(tree, path)
            if found:
                return found
        return None

    @staticmethod
    def _path(node: _Node, path: str) -> tuple[str, str] | None:
        best, rest = None, path.split("/")
        for i, segment in enumerate(rest):
            for n in range(len(segment), -1, -1):
                if segment[:n] in node.ends:
                    best = node.ends[segment[:n]]
                    break
            if i + 1 == len(rest):  # no slash after the last segment
                break
            node = node.next.get(segment)
            if node is None:
                break
        return best


_TRIES: dict[tuple[Rule, ...], UrlTrie] = {}


def _trie(rules: tuple[Rule, ...]) -> UrlTrie:
    if rules not in _TRIES:
        _TRIES.clear()
        _TRIES[rules] = UrlTrie(rules)
    return _TRIES[rules]


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """Host, path, winning rule and verdict of every row.

    A null or unparsable url has an empty host and path, fits no rule and
    gets ``default``; a null id stays null; repeated rows are judged
    repeatedly; an empty table gives no rows. Other columns are not read.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the broadcast trie takes {MAX_RULES} at most")
    shared = pages.sparkSession.sparkContext.broadcast(tuple(rules))

    def judge(cols):
        trie = _trie(shared.value)
        out = {"id": cols["id"], "host": [], "path": [], "rule": [], "verdict": []}
        for url in cols["url"]:
            host, path = split_url(url)
            rule, verdict = trie.lookup(host, path) or (None, default)
            for k, v in (("host", host), ("path", path), ("rule", rule), ("verdict", verdict)):
                out[k].append(v)
        return out

    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"))
    return map_rows(rows, judge, SCHEMA)
