"""The corpus pipeline: from ``documents`` to packed token sequences, in five stages.

1. quality rules: documents that fail are dropped, boilerplate lines removed;
2. n-gram join: one document of each group of similar ones stays, the least id;
3. substring dedup: repeated passages are cut out of all but their first document,
   and documents that consist of nothing else are dropped;
4. secret scans: credentials are replaced by a mark, widely copied examples are not;
5. packing: token ids in sequences, as pieces of documents.

Each function takes what its predecessor kept and returns the columns of
documents; the last returns a row per piece, with its ids. ``n_chars`` follows
the text. Where a stage joins verdicts to documents, it first writes the
documents with row numbers, so ids may be null or repeated: rows with one id and
different texts are documents of their own. Documents without an id pass the stages
that compare documents.

A stage's result is written before the next stage begins (``run`` does so). Its
columns carry, as metadata that Parquet keeps, the names of the intermediate tables
that the stage leaves; the next one deletes those, unless its input was not written
and still reads them. No stage knows of any others.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from entryflow.llm import ngram_join, packing, quality, secret_scan, substring_dedup
from entryflow.llm.common import (PART_BYTES, STAGED, drop_models, give_back, reads_from, remove_folder,
                                  stage, table)
from entryflow.llm.queries import END_ID, SEQUENCE_TOKENS, vocabulary_path
from entryflow.operators.numbering import assign_numbers

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: Name of the columns' metadata that lists what a stage leaves.
_LEAVES = "entryflow.leaves"


def _leaves(docs: DataFrame) -> set[str]:
    """Intermediate tables that the stage before left."""
    return {p for f in docs.schema.fields for p in f.metadata.get(_LEAVES, [])}


def _clearing(fn: Stage) -> Stage:
    """The stage, deleting what the one before left, and telling what it leaves itself."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for path in _leaves(docs) - reads_from(docs):
            remove_folder(spark, path)
        with STAGED.watched() as own:
            out = fn(spark, docs, sf_dir)
        first, *rest = out.columns
        return out.select(F.col(first).alias(first, metadata={_LEAVES: own}), *rest)
    return run_stage


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """The documents as ``doc``, with a ``row`` number that stays."""
    return stage(docs.select(F.struct("*").alias("doc"),
                             F.monotonically_increasing_id().alias("row")), name)


def _fields(rows: DataFrame) -> DataFrame:
    return rows.select("row", "doc.doc_id", "doc.text", "doc.source")


def _own_ids(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows with ``own``, an id that no other row has, and ``row, own, doc_id`` of repeated ids.

    The first row of an id keeps it; the others get numbers beyond all ids. They are few, as
    a rule, and written, so the planner joins them by their size.
    """
    ids = rows.select("row", "doc.doc_id").where("doc_id is not null")
    repeated = ids.groupBy("doc_id").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    others = ids.join(repeated, "doc_id").where("row <> first").select("row", "doc_id", F.lit(0).alias("all"))
    ends = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    beyond = F.col("n") + F.lit(ends[1] or 0) + 1
    if (ends[1] or 0) > 1 << 62:  # no room above
        beyond = F.lit(ends[0]) - 1 - F.col("n")
    more = stage(assign_numbers(others, "all", ["doc_id", "row"], out_col="n")
                 .select("row", beyond.alias("own"), "doc_id"), name)
    own = F.coalesce("own", F.col("doc.doc_id").cast("long"))
    return rows.join(more.select("row", "own"), "row", "left").withColumn("own", own), more


def _with_text(rows: DataFrame, text: Column) -> DataFrame:
    doc = (F.col("doc").withField("text", text)
           .withField("n_chars", F.length(text).cast("long")))
    return rows.select(doc.alias("doc")).select("doc.*")


def _edit(edited: Callable[[str, object], str]) -> Callable[[Column, Column], Column]:
    """A function of columns that gives ``edited(text, marks)`` of rows with marks, some
    ``PART_BYTES`` of texts at a time, and leaves no models and little memory with its worker."""
    @F.pandas_udf(StringType())
    def edit(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        drop_models()
        for texts, marks in batches:
            out, held = [], 0
            for t, m in zip(texts, marks):
                out.append(t if m is None else edited(t, m))
                held += len(out[-1] or "")
                if held >= PART_BYTES:
                    yield pd.Series(out, dtype=object)
                    out, held = [], 0
            if out:
                yield pd.Series(out, dtype=object)
        give_back()

    return edit


def _spans(marks: object) -> list[tuple[int, int]]:
    return [(x["start"], x["end"]) for x in marks]


_drop_lines = _edit(quality.without_lines)
_cut_out = _edit(lambda text, cuts: substring_dedup.cut_out(text, _spans(cuts)))
_redact = _edit(lambda text, spans: secret_scan.redact(text, _spans(spans)))


def _edited(edit: Callable[[Column, Column], Column], marks: str) -> Column:
    """``edit(text, marks)`` for rows with marks. The other texts, most of them, stay as they are
    and do not go to Python, so they take no room in Arrow batches on either side."""
    text, marked = F.col("doc.text"), F.col(marks)
    return F.coalesce(edit(F.when(marked.isNotNull(), text), marked), text)


@_clearing
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs, "quality_docs")
    kept = quality.judge(_fields(rows), row_col="row").where("kept").select("row", "drop_lines")
    return _with_text(rows.join(kept, "row"), _edited(_drop_lines, "drop_lines"))


@_clearing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of a group stays; of rows with one id and no words, one."""
    rows, more = _own_ids(_numbered(docs, "join_docs"), "join_more_ids")
    found = stage(ngram_join.near_components(rows.select("row", "own", "doc.text"), id_col="own", row_col="row"),
                  "join_components")
    first = found.where("n_shingles > 0 and id = component_id").select("row")
    wordless = found.where("n_shingles = 0 and id is not null").join(more.select("row", "doc_id"), "row", "left")
    empty = wordless.groupBy(F.coalesce("doc_id", "id").alias("of")).agg(F.min("row").alias("row")).select("row")
    stay = first.union(empty).union(found.where("id is null").select("row"))
    return rows.join(stay, "row", "left_semi").select("doc.*")


@_clearing
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, _ = _own_ids(_numbered(docs, "passage_rows"), "passage_more_ids")
    regions = substring_dedup.repeated_regions(rows.select("own", "doc.text"), id_col="own").where("removed")
    cuts = stage(regions.groupBy("id").agg(F.flatten(F.collect_list("cuts")).alias("cuts")),
                 "passage_cuts")
    marked = rows.join(cuts, rows["own"] == cuts["id"], "left")
    text = _edited(_cut_out, "cuts")
    left = marked.select("doc", text.alias("left"), F.col("cuts").isNotNull().alias("was_cut"))
    return _with_text(left.where("not was_cut or left <> ''"), F.col("left"))


@_clearing
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _numbered(docs, "secret_docs")
    found = secret_scan.find_secrets(_fields(rows), row_col="row").where(F.size("redact") > 0)
    marked = rows.join(found.select("row", "redact"), "row", "left")
    return _with_text(marked, _edited(_redact, "redact"))


@_clearing
def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, vocabulary_path(), END_ID, SEQUENCE_TOKENS, keep_ids=True)
    return packing.pack(pieces, SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("ngram join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", secrets),
    ("packing", packed_sequences),
]

#: Hashes, components and a tokenizer: not to be expressed in SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), name.replace(" ", "_"))
    for path in _leaves(docs):
        remove_folder(spark, path)
    return docs
