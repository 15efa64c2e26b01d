"""Secret scan with corpus-wide ownership frequency.

One pass finds the spans of three base kinds in every whole text, and bare
tokens that might be credentials. The values are hashed, and the hashes
aggregated over the corpus by distinct repositories and owners. Copies of one
text count as one repository of one owner, so a copied document does not make
its own credential an example; texts too short to be told from a quoted snippet
count each for itself. A value held by many owners, or in very many
repositories, is a copied example; another one that also looks live (enough letters of different kinds, no placeholder) is a credential of
its owner. Base spans always stay and are only classified; a bare token
becomes a span when it is owner-specific and looks live.

The text is read once. What is written and shuffled is spans and hashes; a
value that stands in a third of the documents is counted by (value, owner,
text), then (value, owner), then value, each with a map-side part.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import map_rows, stage

#: Values with this many owners or more are copied examples.
EXAMPLE_OWNERS = 5
#: So are values in this many repositories or more, whoever owns them.
EXAMPLE_REPOS = 100
#: A text of this many words or more that stands in several sources is a copy of one document.
COPY_WORDS = 20
#: Bare tokens have this many characters at least.
BARE_CHARS = 20
#: Bits of entropy per character that a live-looking value has at least.
LIVE_ENTROPY = 3.0

#: In the order in which spans with an equal start are listed.
KINDS = ("assign", "access", "hex", "bare")

# The patterns of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

_BARE = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{BARE_CHARS},}}")
_DIGIT = re.compile(r"[0-9]")
_PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|changeme|your[_-]|xxxx|0000|1234", re.I)

Span = tuple[str, int, int, str]  # kind, start, end, value


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind, by start, then kind."""
    out: list[Span] = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "apikey", "api_key")):
        out += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text)
                if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def looks_live(value: str) -> bool:
    """Random enough for a credential, and no usual placeholder."""
    if _PLACEHOLDER.search(value):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= LIVE_ENTROPY


def bare_spans(text: str, taken: list[Span]) -> list[Span]:
    """Long tokens with letters and digits that no base span touches."""
    if not _DIGIT.search(text):
        return []
    covered: list[list[int]] = []  # the spans' union as disjoint intervals
    for _, start, end, _ in taken:
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    out, i = [], 0
    for m in _BARE.finditer(text):
        while i < len(covered) and covered[i][1] <= m.start():
            i += 1
        if i < len(covered) and covered[i][0] < m.end():
            continue
        value = m[0]
        if _DIGIT.search(value) and re.search("[A-Za-z]", value):
            out.append(("bare", m.start(), m.end(), value))
    return out


def span_text(spans) -> str:
    return ",".join(f"{s[0]}:{s[1]}:{s[2]}" for s in spans)


def text_hash(text: str) -> int | None:
    """Hash of the words, or null for a text too short to be a copied document."""
    import xxhash
    ws = text.split()
    if len(ws) < COPY_WORDS:
        return None
    h = xxhash.xxh3_64_intdigest(" ".join(ws).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


_SPAN = "array<struct<kind:string,start:int,end:int,value_hash:string,live:boolean>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", row_col: str | None = None) -> DataFrame:
    """One row per document, without its text: base counts and spans, and candidates.

    Written to the shared folder. ``row`` numbers the rows, or is ``row_col``.
    """
    def run(cols):
        out = {k: [] for k in ("text_hash", "n_assign", "n_access", "n_hex", "base", "base_sha256",
                               "found")}
        for text in cols["text"]:
            text = text or ""
            out["text_hash"].append(text_hash(text))
            base = base_spans(text)
            kinds = Counter(s[0] for s in base)
            for k in ("assign", "access", "hex"):
                out[f"n_{k}"].append(kinds[k])
            out["base"].append(span_text(base))
            out["base_sha256"].append(hashlib.sha256(out["base"][-1].encode()).hexdigest())
            out["found"].append([
                {"kind": k, "start": a, "end": b, "live": looks_live(v),
                 "value_hash": hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest()[:32]}
                for k, a, b, v in base + bare_spans(text, base)])
        return {"id": cols["id"], "owner": cols["owner"], "at": cols["at"], **out}

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.col(owner_col).cast("string").alias("owner"),
                       (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("at"))
    found = map_rows(rows, run, "id long, owner string, at long, text_hash long, n_assign long, n_access long, "
                                f"n_hex long, base string, base_sha256 string, found {_SPAN}")
    row = F.col("at") if row_col else F.monotonically_increasing_id()
    return stage(found.withColumn("row", row).drop("at"), "secret_scan")


def ownership(scanned: DataFrame) -> DataFrame:
    """Distinct repositories and owners of every candidate value.

    A text stands for a repository, however many documents are copies of it, and
    belongs to one of their owners (picked by hash, so that several texts that
    were copied to the same owners are not all one's). A document with a text
    too short for that (see ``text_hash``) stands for itself, by its id. A null
    owner counts as one owner of its own; a document without an id as a
    repository of its own.
    """
    held = scanned.where(F.size("found") > 0).select(
        F.coalesce("owner", F.lit("\0")).alias("owner"), "text_hash",
        F.coalesce("id", -1 - F.col("row")).alias("doc"),
        F.array_distinct("found.value_hash").alias("values"))
    # an owner's number; the least of a text's is its owner's
    number = F.xxhash64("owner", "text_hash")
    texts = (held.where("text_hash is not null")
             .select("text_hash", number.alias("number"), F.explode("values").alias("value_hash"), "owner")
             .groupBy("value_hash", "text_hash").agg(F.min_by("owner", "number").alias("owner"))
             .select("value_hash", "owner", F.lit(1).alias("one")))
    short = (held.where("text_hash is null")
             .select(F.explode("values").alias("value_hash"), "owner", "doc").distinct()
             .select("value_hash", "owner", F.lit(1).alias("one")))
    return (texts.union(short)
            .groupBy("value_hash", "owner").agg(F.sum("one").alias("repos"))
            .groupBy("value_hash").agg(F.sum("repos").alias("n_repos"),
                                       F.count(F.lit(1)).alias("n_owners")))


def judged_spans(scanned: DataFrame, example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """Every span with its value's ownership and verdict.

    ``verdict``: ``copied`` (a value of ``example_owners`` owners or more, or in
    ``EXAMPLE_REPOS`` repositories), ``live`` (of fewer and live-looking) or ``weak``. Bare tokens that
    are not live are left out.
    """
    # written, so that both sides of the join are plain shuffles that AQE can split
    owners = stage(ownership(scanned), "secret_owners")
    spans = (scanned.select("row", "id", F.explode("found").alias("s"))
             .select("row", "id", "s.*").join(owners, "value_hash"))
    verdict = (F.when((F.col("n_owners") >= example_owners)
                      | (F.col("n_repos") >= EXAMPLE_REPOS), "copied")
               .when(F.col("live"), "live").otherwise("weak"))
    return spans.withColumn("verdict", verdict).where("kind <> 'bare' or verdict = 'live'")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 owner_col: str = "source", example_owners: int = EXAMPLE_OWNERS,
                 row_col: str | None = None) -> DataFrame:
    """Spans and their digest of every document: ``row, id, n_assign, n_access, n_hex,
    base_sha256, spans, n_live, n_copied, redact``.

    ``redact`` lists the [start, end) of all spans but copied examples. A
    null text counts as empty and has no spans; repeated rows and documents
    with an equal or null id are judged row by row (an id counts once as a
    repository); an empty table gives no rows. Spans count code points.
    """
    scanned = scan(docs, id_col, text_col, owner_col, row_col)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    per_row = (judged_spans(scanned, example_owners)
               .groupBy("row").agg(
                   F.array_sort(F.collect_list(F.struct("start", order.alias("o"), "end", "kind",
                                                        "verdict"))).alias("all"))
               .select("row",
                       F.array_join(F.transform("all", lambda s: F.concat_ws(
                           ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
                           ",").alias("spans"),
                       F.size(F.filter("all", lambda s: s["verdict"] == "live")).cast("long").alias("n_live"),
                       F.size(F.filter("all", lambda s: s["verdict"] == "copied")).cast("long").alias("n_copied"),
                       F.transform(F.filter("all", lambda s: s["verdict"] != "copied"),
                                   lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
                       .alias("redact")))
    none = F.lit(0).cast("long")
    return (scanned.drop("base", "found", "text_hash").join(per_row, "row", "left")
            .select("row", "id", "n_assign", "n_access", "n_hex", "base_sha256",
                    F.coalesce("spans", F.lit("")).alias("spans"),
                    F.coalesce("n_live", none).alias("n_live"),
                    F.coalesce("n_copied", none).alias("n_copied"), "redact"))


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with the (possibly overlapping) spans replaced by a mark."""
    out, last = [], 0
    for start, end in sorted(spans):
        if start >= last:
            out += [text[last:start], mark]
        last = max(last, end)
    return "".join(out) + text[last:]
