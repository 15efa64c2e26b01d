"""Quality rules with cross-document line frequency.

One pass measures every whole text and hashes its normalised lines (words
lower-cased, digits as 0, single spaces). Lines are then counted by distinct
documents per host; a line above its host's limit is boilerplate. A document
that loses more than ``MAX_LOST`` of its words with such lines is depleted and
rejected; from the others the lines are removed.

Distinct documents are texts told apart by a hash of all their lower-cased words, and
near copies of one text count once: of the texts that hold a line above a limit (no
other text can matter), those with a Jaccard similarity of 0.8 or more of all their 5-word
windows are one class, found by MinHash bands and verified. So a much copied document
does not make its own lines boilerplate, while documents that share a template but are no
near copies count one by one. A host's total counts its different texts.

Texts are read once and not shuffled; the few that classes are made of are read again.
Line counts are aggregated by (host, line, text), then by (host, line), with map-side
parts, so a host with a third of all rows is spread over its lines. Frequent lines are
few: a host has at most (its lines / ``MIN_DOCS``) of them. They are joined by key, and a
line that stands in many documents is a skewed key that Spark splits.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from entryflow.llm.common import (map_rows, shingle_hashes, squeeze_keys, stage, utf8,
                                  word_hashes)
from entryflow.llm.graph import components
from entryflow.llm.substring_dedup import band_members, similar_pairs, tune_bands

#: A line is boilerplate in more than this share of a host's documents ...
MAX_SHARE = 0.1
#: ... and in this many at least,
MIN_DOCS = 10
#: or in this many of them, however large the host is.
MAX_DOCS = 30
#: Words of the windows by which near copies are told, and texts of a band's key that the
#: others are compared with.
WINDOW, PIVOTS = 5, 3
#: Rows of two hashes (16 MB) that are sent to all tasks at most.
BROADCAST_ROWS = 1_000_000
#: A document that loses more than this share of its words is depleted.
MAX_LOST = 0.5
#: Base rules: fewest words, and the largest share of repeated words in percent.
MIN_WORDS, MAX_REPEAT = 50, 50

_SYMBOLS, _SPACES = "#*$%&|<>", " \t\n\v\f\r"
_ZEROS = bytes.maketrans(b"123456789", b"000000000")


def line_hashes(text: str | None) -> tuple[np.ndarray, list[int]]:
    """Hash and words of every normalised line that has a word, in order."""
    import xxhash
    hashes, counts = [], []
    for line in utf8(text).lower().translate(_ZEROS).split(b"\n"):
        ws = line.split()
        if ws:
            hashes.append(xxhash.xxh3_64_intdigest(b" ".join(ws)))
            counts.append(len(ws))
    return np.array(hashes, dtype=np.uint64).view(np.int64), counts


def _twice(hashes: np.ndarray) -> np.ndarray | None:
    """Which values stand there more than once; None if none does."""
    ordered = np.sort(hashes)
    if not (ordered[1:] == ordered[:-1]).any():
        return None
    order = np.argsort(hashes)
    same = hashes[order[1:]] == hashes[order[:-1]]
    out = np.zeros(len(hashes), dtype=bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def measures(text: str | None) -> dict[str, int]:
    """Words, their code points, signs, repeated lines, and words in repeated 3-word windows."""
    data = utf8(text)
    h = word_hashes(data)
    seen, dup_lines = set(), 0
    for line in data.split(b"\n"):
        if line.split(None, 1):
            dup_lines += line in seen
            seen.add(line)
    repeated = 0
    twice = _twice(shingle_hashes(h, 3)) if len(h) >= 4 else None
    if twice is not None:
        inside = np.zeros(len(h), dtype=bool)
        for i in range(3):
            inside[i:i + len(twice)] |= twice
        repeated = int(inside.sum())
    return {"n_words": len(h),
            "word_chars": len(text or "") - sum(map((text or "").count, _SPACES)),
            "n_symbols": sum(map((text or "").count, _SYMBOLS)),
            "n_dup_lines": dup_lines, "n_repeat_words": repeated}


def text_hash(text: str | None) -> int:
    """Hash of the lower-cased words in order."""
    import xxhash
    h = xxhash.xxh3_64_intdigest(b" ".join(utf8(text).lower().split()))
    return h - (1 << 64) if h >> 63 else h


def _source_rows(docs: DataFrame, text_col: str, *columns) -> DataFrame:
    """Texts with ``raw``, by which a second reading finds them again."""
    return docs.select(*columns, F.col(text_col).alias("text"), F.xxhash64(text_col).alias("raw"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         host_col: str = "source", row_col: str | None = None) -> DataFrame:
    """Measures, text hash and line hashes of every document, without its text.

    Written to the shared folder. ``row`` numbers the rows, or is ``row_col``.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(cols):
        out = {k: [] for k in [*names, "sketch", "lines", "line_words"]}
        for text in cols["text"]:
            for k, v in measures(text).items():
                out[k].append(v)
            hashes, counts = line_hashes(text)
            out["sketch"].append(text_hash(text))
            out["lines"].append(hashes)
            out["line_words"].append(counts)
        return {"id": cols["id"], "host": cols["host"], "at": cols["at"], "raw": cols["raw"], **out}

    rows = _source_rows(docs, text_col, F.col(id_col).cast("long").alias("id"),
                        F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"),
                        (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("at"))
    schema = ("id long, host string, at long, raw long, " + ", ".join(f"{n} long" for n in names)
              + ", sketch long, lines array<long>, line_words array<int>")
    row = F.col("at") if row_col else F.monotonically_increasing_id()
    return stage(map_rows(rows, run, schema).withColumn("row", row).drop("at"), "quality_scan")


def _sent(hashes: DataFrame) -> DataFrame:
    """A written table of hashes, to be sent to the tasks that hold the texts, so that those need
    not move, if it is small; if not, the planner chooses."""
    return F.broadcast(hashes) if hashes.count() <= BROADCAST_ROWS else hashes


def near_classes(docs: DataFrame, wanted: DataFrame, text_col: str = "text") -> DataFrame:
    """``sketch, label`` of the texts ``wanted`` (``raw, sketch``, a row for each sketch) that have
    near copies among them.

    In each band, a key's texts are compared with ``PIVOTS`` of them at most, chosen by as many
    orders, so that texts which one pivot does not connect meet others; the orders are the same
    in all bands, so a group of copies meets few pivots in all.
    """
    bands, band_rows = tune_bands()

    def windows(cols):
        # copies of a text in one batch give one set
        texts = dict(zip(cols["sketch"], cols["text"]))
        sets = [np.unique(shingle_hashes(word_hashes(utf8(t), lower=True), WINDOW)) for t in texts.values()]
        return {"hash": list(texts), "shingles": [squeeze_keys(s) for s in sets]}

    texts = (_source_rows(docs, text_col).join(_sent(wanted), "raw").where("text is not null")
             .select("text", "sketch"))
    sets = stage(map_rows(texts, windows, "hash long, shingles binary"), "quality_sets")
    members = stage(band_members(sets, bands, band_rows).distinct(), "quality_members")
    chosen = [F.min(F.struct(F.xxhash64("hash", F.lit(i)).alias("by"), F.col("hash").alias("a")))
              for i in range(PIVOTS)]
    pivots = stage(members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.array(*chosen).alias("pivots"))
                   .where("m > 1").select("key", F.explode(F.array_distinct("pivots.a")).alias("a")),
                   "quality_pivots")
    pairs = stage(members.join(pivots, "key").where("a <> hash")
                  .select(F.least("a", "hash").alias("a"), F.greatest("a", "hash").alias("b")).distinct(),
                  "quality_pairs")
    # most texts are in no pair; a set that several tasks made is needed once
    paired = stage(pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct(), "quality_paired")
    sets = stage(sets.join(_sent(paired), "hash", "left_semi").dropDuplicates(["hash"]), "quality_paired_sets")
    near = stage(similar_pairs(sets, pairs), "quality_links")
    return components(near).withColumnRenamed("node", "sketch")


def frequent_lines(scanned: DataFrame, docs: DataFrame, text_col: str = "text", max_share: float = MAX_SHARE,
                   min_docs: int = MIN_DOCS, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line) above one of the host's limits, with the distinct documents it stands in."""
    per_host = stage(scanned.groupBy("host", "sketch").agg(F.lit(1).alias("one"))
                     .groupBy("host").agg(F.count(F.lit(1)).alias("host_docs")), "quality_hosts")

    def above(docs):
        """Lines with so many documents that they are above a limit."""
        count = F.col(docs)
        return (count >= min_docs) & ((count > max_share * F.col("host_docs")) | (count >= max_docs))

    lines = scanned.select("host", "sketch", F.explode("lines").alias("line"))
    # classes can only lower a line's count, so no other line matters
    often = stage(lines.groupBy("host", "line", "sketch").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("texts"))
                  .where(F.col("texts") >= min_docs).join(per_host, "host").where(above("texts"))
                  .select("host", "line"), "quality_often")
    holding = stage(lines.join(often, ["host", "line"]).select("host", "line", "sketch").distinct(),
                    "quality_holding")
    some = scanned.select("sketch", "raw").join(holding.select("sketch").distinct(), "sketch", "left_semi")
    wanted = stage(some.groupBy("sketch").agg(F.min("raw").alias("raw")), "quality_wanted")
    labels = near_classes(docs, wanted, text_col)
    per_line = (holding.join(labels, "sketch", "left").withColumn("class", F.coalesce("label", "sketch"))
                .groupBy("host", "line", "class").agg(F.lit(1).alias("one"))
                .groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")))
    return per_line.join(per_host, "host").where(above("docs")).select("host", "line", "docs")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          host_col: str = "source", row_col: str | None = None) -> DataFrame:
    """Measures and verdict of every document, and the numbers of its lines to remove.

    Columns: ``row, id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_lost_words, drop_lines`` (indexes
    among the lines with a word, null without any). A null or empty text has
    no words and fails the base rules. A null host is a host of its own;
    null ids and repeated rows are judged row by row (repeated texts count
    once in line counts); an empty table gives no rows.
    """
    scanned = scan(docs, id_col, text_col, host_col, row_col)
    # written, so that both sides of the join are plain shuffles that AQE can split
    frequent = stage(frequent_lines(scanned, docs, text_col), "quality_lines")
    lines = scanned.select("row", "host", F.posexplode(F.arrays_zip("lines", "line_words"))
                           .alias("number", "l")).select("row", "host", "number", "l.*")
    lost = (lines.join(frequent, (lines["host"] == frequent["host"])
                       & (lines["lines"] == frequent["line"]))
            .groupBy("row").agg(F.sum("line_words").alias("n_lost"),
                                F.collect_list("number").alias("drop_lines")))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    n_lost = F.coalesce("n_lost", F.lit(0)).cast("long")
    return (scanned.drop("host", "sketch", "raw", "lines", "line_words").join(lost, "row", "left")
            .select("row", "id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", failed.alias("base_failed"),
                    (~failed & (n_lost <= MAX_LOST * F.col("n_words"))).alias("kept"),
                    n_lost.alias("n_lost_words"), "drop_lines"))


def without_lines(text: str, numbers: list[int]) -> str:
    """``text`` without some of its lines that have a word, by number."""
    drop, kept, n = set(numbers), [], 0
    for line in text.split("\n"):
        has_word = bool(utf8(line).split())
        if not (has_word and n in drop):
            kept.append(line)
        n += has_word
    return "\n".join(kept)
