"""One commit list per table, for streams and batch writers alike.

A table is a folder of plain data files, as any Spark reader sees it. Below it::

    _commits/files/<commit>-<attempt>/   files of a commit on their way; readers skip them
    _commits/list/<commit>.json          the commit: its files, and files it replaces
    _commits/published/<commit>          all its files stand in the table's folder

A commit is named by its writer and a number, for a stream the query's id and the
micro-batch. Its record is created once, by an exclusive rename: that settles whose
files it has. It counts when all of them stand in the folder and its mark is set.
Whoever writes the same commit again (a retried micro-batch, a rerun job) finds the
record and adds nothing; if the first attempt was cut off between record and mark,
the second finishes that. No file of the table is deleted or renamed to write
another, so no order of writers hides rows of a third, and readers keep their files.

``read_table`` reads whole commits only. A plain reader of the folder sees a
commit's files one by one as they are moved in. ``compact`` replaces small files by
larger ones through the same list: ``read_table`` takes the larger ones at once, plain
readers go on with the small ones until ``settle``.
"""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Sequence
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Records of one writer that stay after they are published (only its last can be written again).
KEEP = 100
#: Files renamed at a time.
THREADS = 16
#: Compaction: files below the first size are merged into files of about the second.
SMALL_BYTES, FILE_BYTES = 32 << 20, 256 << 20

COMPACTION = "compaction"
#: The list that Spark's own file sink keeps, and readers of a folder then follow.
FILE_LOG = "_spark_metadata"


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of a catalog table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


class Folder:
    """A folder on any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(self._conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str) -> list[str]:
        """Names in a folder below, none if it is not there."""
        if not self.exists(name):
            return []
        try:
            return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(name)))
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):  # deleted since
                return []
            raise

    def data_files(self, name: str) -> list[str]:
        """Data files at any depth of a folder below, relative to it; hidden names are skipped."""
        if not self.exists(name):
            return []
        out, found = [], self._fs.listFiles(self._path(name), True)
        base = self._fs.makeQualified(self._path(name)).toUri().getPath().rstrip("/") + "/"
        while found.hasNext():
            rel = found.next().getPath().toUri().getPath().removeprefix(base)
            if not re.search(r"(^|/)[_.]", rel):
                out.append(rel)
        return sorted(out)

    def read(self, name: str) -> str | None:
        """Text of a small file, None if it is not there."""
        try:
            stream = self._fs.open(self._path(name))
        except Py4JJavaError as e:
            if _is(e, "FileNotFoundException"):
                return None
            raise
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        out = self._fs.create(self._path(name), True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()

    def create(self, name: str, text: str) -> bool:
        """Write a small file, whole or not at all; False if there is one of that name."""
        part = f"_commits/{uuid.uuid4().hex}.tmp"
        self.write(part, text)
        if self.move(part, name):
            return True
        self.delete(part)
        return False

    def move(self, name: str, to: str) -> bool:
        """Rename without replacing; False if the target is there or the source is not."""
        target = self._path(to)
        self._fs.mkdirs(target.getParent())
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(rename, 0)
        try:
            self._context.rename(self._path(name), target, none)
            return True
        except Py4JJavaError as e:
            if _is(e, "FileAlreadyExistsException", "FileNotFoundException"):
                return False
            raise

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


class CommitList:
    """The commits of a table at ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.folder = Folder(spark, root)
        if self.folder.exists(FILE_LOG):
            raise ValueError(
                f"{root} has a {FILE_LOG} list of Spark's file sink: readers follow it and would not "
                "see other writers' files. Write to a new folder, or copy the rows to one.")

    @staticmethod
    def name(writer: str, number: int) -> str:
        return f"{re.sub(r'[^A-Za-z0-9_.]', '_', writer)}-{int(number):012d}"

    def record(self, commit: str) -> dict | None:
        text = self.folder.read(f"_commits/list/{commit}.json")
        return None if text is None else json.loads(text)

    def pending(self) -> list[dict]:
        """Commits whose files are not all published."""
        listed = [n.removesuffix(".json") for n in self.folder.names("_commits/list") if n.endswith(".json")]
        done = set(self.folder.names("_commits/published"))
        found = [self.record(c) for c in listed if c not in done]
        return [r for r in found if r is not None]

    def add(self, commit: str, attempt: str, files: Sequence[str], remove: Sequence[str] = ()) -> bool:
        """Create the record; False if the commit is there already."""
        record = {"commit": commit, "dir": f"_commits/files/{attempt}", "files": list(files),
                  "remove": list(remove)}
        return self.folder.create(f"_commits/list/{commit}.json", json.dumps(record))

    def publish(self, record: dict) -> None:
        """Move a commit's files into the table and delete what they replace; may be repeated."""
        def move(name: str) -> None:
            self.folder.move(f"{record['dir']}/{name}", name)

        with ThreadPoolExecutor(THREADS) as pool:
            list(pool.map(move, record["files"]))
            list(pool.map(self.folder.delete, record["remove"]))
        self.folder.write(f"_commits/published/{record['commit']}", "")
        self.folder.delete(record["dir"])

    def forget(self, commit: str) -> None:
        self.folder.delete(f"_commits/list/{commit}.json")
        self.folder.delete(f"_commits/published/{commit}")

    def is_published(self, commit: str) -> bool:
        return self.folder.exists(f"_commits/published/{commit}")


def commit_rows(df: DataFrame, target: str, writer: str | None = None, number: int = 0,
                fmt: str = "parquet", as_table: bool = False,
                partition_by: Sequence[str] = ()) -> bool:
    """Add rows to a folder or catalog table as one commit; False if it was there already.

    ``writer`` and ``number`` name the commit; without a writer the rows are added
    under a new name, whatever was added before.
    """
    spark = df.sparkSession
    commits = CommitList(spark, table_location(spark, target) if as_table else target)
    commit = commits.name(writer or uuid.uuid4().hex, number)
    record = commits.record(commit)
    new = record is None
    if new:
        attempt = f"{commit}-{uuid.uuid4().hex[:8]}"
        out = df.write.format(fmt)
        if partition_by:
            out = out.partitionBy(*partition_by)
        out.save(f"{commits.folder.root}/_commits/files/{attempt}")
        new = commits.add(commit, attempt, commits.folder.data_files(f"_commits/files/{attempt}"))
        if not new:  # another driver was first
            commits.folder.delete(f"_commits/files/{attempt}")
        record = commits.record(commit)
    if not commits.is_published(commit):
        commits.publish(record)
    if writer is None:
        commits.forget(commit)
    elif number >= KEEP:
        commits.forget(commits.name(writer, number - KEEP))
    if as_table:
        if partition_by:
            spark.sql(f"ALTER TABLE {target} RECOVER PARTITIONS")
        spark.catalog.refreshTable(target)
    return new


def _relative(paths: Sequence[str], root: str) -> dict[str, str]:
    """Names below ``root`` of files that a DataFrame reads, with the path to read them by."""
    base = urlparse(root).path.rstrip("/") + "/"
    return {unquote(urlparse(p).path).removeprefix(base): p for p in paths}


def committed_files(spark: SparkSession, root: str, schema: T.StructType | str = "entryflow_any int",
                    fmt: str = "parquet") -> tuple[list[str], dict[str, list[str]]]:
    """Files of the table that count now: those in its folder, and by folder those that
    compactions have written. If a commit came while they were listed, they are listed again."""
    commits = CommitList(spark, root)
    while True:
        before = commits.pending()
        staged = {r["dir"]: [n for n in r["files"] if commits.folder.exists(f"{r['dir']}/{n}")]
                  for r in before if r["remove"]}
        there = _relative(spark.read.schema(schema).format(fmt).load(commits.folder.root).inputFiles(),
                          commits.folder.root) if commits.folder.exists("") else {}
        if [r["commit"] for r in commits.pending()] == [r["commit"] for r in before]:
            break
    gone = {name for r in before for name in r["remove"] or r["files"]}
    files = [p for name, p in there.items() if name not in gone]
    return files, {d: [n for n in names if n not in there] for d, names in staged.items()}


def read_table(spark: SparkSession, target: str, as_table: bool = False, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Every committed row once, also while others write or compact."""
    if as_table:
        schema = schema or spark.table(target).schema
        target = table_location(spark, target)
    target = target.rstrip("/")
    if schema is None:
        schema = spark.read.format(fmt).load(target).schema
    files, staged = committed_files(spark, target, schema, fmt)

    def read(base: str, paths: list[str]) -> DataFrame:  # a folder's name may hold columns
        return spark.read.schema(schema).option("basePath", base).format(fmt).load(paths)

    parts = [read(target, files)] if files else []
    parts += [read(f"{target}/{d}", [f"{target}/{d}/{n}" for n in names]) for d, names in staged.items() if names]
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compact(spark: SparkSession, target: str, small_bytes: int = SMALL_BYTES,
            file_bytes: int = FILE_BYTES, as_table: bool = False, fmt: str = "parquet") -> int:
    """Merge the small files of each folder of the table; how many were merged.

    The new files and the names of the old ones become one commit, so ``read_table``
    sees either. Of two compactions at a time one counts, the other drops its files.
    """
    schema = spark.table(target).schema if as_table else None
    root = (table_location(spark, target) if as_table else target).rstrip("/")
    commits = CommitList(spark, root)
    taken = [n for n in commits.folder.names("_commits/list") if n.startswith(COMPACTION)]
    number = 1 + max((int(n.removesuffix(".json").rpartition("-")[2]) for n in taken), default=0)
    if schema is None:
        schema = spark.read.format(fmt).load(root).schema
    files, _ = committed_files(spark, root, schema, fmt)
    if not files:
        return 0
    listed = _relative(files, root)
    sizes = spark.read.format("binaryFile").load(root).select("path", "length").where(F.col("length") < small_bytes)
    small: dict[str, list[tuple[str, str, int]]] = {}
    for r in sizes.collect():  # names and sizes, as the planner lists them anyway
        for name in _relative([r["path"]], root):
            if name in listed:
                small.setdefault(name.rpartition("/")[0], []).append((name, listed[name], r["length"]))
    commit = commits.name(COMPACTION, number)
    attempt = f"{commit}-{uuid.uuid4().hex[:8]}"
    merged: list[str] = []
    for part, found in small.items():
        if len(found) < 2:
            continue
        columns = spark.read.format(fmt).load(found[0][1]).columns  # the folder's name has the others
        own = T.StructType([f for f in schema.fields if f.name in columns])
        n = -(-sum(size for _, _, size in found) // file_bytes)
        (spark.read.schema(own).format(fmt).load([path for _, path, _ in found]).coalesce(n)
         .write.format(fmt).save(f"{root}/_commits/files/{attempt}/{part}".rstrip("/")))
        merged += [name for name, _, _ in found]
    if not merged:
        return 0
    new = commits.folder.data_files(f"_commits/files/{attempt}")
    if not commits.add(commit, attempt, new, merged):
        commits.folder.delete(f"_commits/files/{attempt}")
        return 0
    old = commits.name(COMPACTION, number - KEEP) if number > KEEP else None
    if old and commits.is_published(old):  # else its record still says which files are replaced
        commits.forget(old)
    return len(merged)


def settle(spark: SparkSession, target: str, as_table: bool = False) -> None:
    """Publish every commit that is on its way, and delete the files that compactions replaced
    and those of attempts that were cut off.

    For a time without plain readers of the folder, and after the last job that began to
    read before the compaction has ended."""
    commits = CommitList(spark, table_location(spark, target) if as_table else target)
    for record in commits.pending():
        commits.publish(record)
    for attempt in commits.folder.names("_commits/files"):
        if commits.is_published(attempt.rpartition("-")[0]):
            commits.folder.delete(f"_commits/files/{attempt}")
    if as_table:
        spark.catalog.refreshTable(target)
