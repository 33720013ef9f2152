"""Files with names of their own: a Python data source writer that makes one JSON file of each name, and an index on commit.

Rows of one file lie in one partition, in order. A task writes its files under a name of the job and of the attempt; on commit
the driver gives the files of the tasks that were kept their names, writes the index, and removes all else that the job left,
that of failed and repeated tasks included. Until then no file of the job has its name. Places are those that pyarrow opens:
a path, or an address of a file system that it knows.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import IntegralType

from ..session import by_value

FORMAT = "named_json"


def place(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)


@dataclass
class Made(WriterCommitMessage):
    """The files of a task: name, where it lies, rows, bytes, SHA-256."""

    files: list[tuple[str, str, int, int, str]]


class NamedWriter(DataSourceArrowWriter):
    """Rows (file, piece, and n where a piece is more than one row): pieces are joined by a comma between the brackets of the
    options."""

    def __init__(self, options: dict, overwrite: bool):
        self.root, self.open, self.close = options["path"].rstrip("/"), options.get("open", "["), options.get("close", "]")
        self.index, self.overwrite = options.get("index", ""), overwrite
        self.job = f"{self.root}/_job-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, job = place(self.job)
        top, files, now, out = f"{job}/{uuid.uuid4().hex}", [], None, None
        rows = size = 0
        digest = hashlib.sha256()

        def put(text: str) -> None:
            nonlocal size
            data = text.encode()
            out.write(data)
            digest.update(data)
            size += len(data)

        def finish() -> None:
            put(self.close + "\n")
            out.close()
            files.append((now, f"{top}/{now}", rows, size, digest.hexdigest()))

        for batch in batches:
            counts = batch.column("n").to_pylist() if "n" in batch.schema.names else [1] * batch.num_rows
            for name, piece, n in zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist(), counts, strict=True):
                if name != now:
                    if out is not None:
                        finish()
                    now, rows, size, digest = name, 0, 0, hashlib.sha256()
                    system.create_dir(f"{top}/{name}".rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(f"{top}/{name}")
                    put(self.open)
                put((", " if rows else "") + piece)
                rows += n
        if out is not None:
            finish()
        return Made(files)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        system, root = place(self.root)
        files = sorted(f for m in messages if m is not None for f in m.files)
        names = [f[0] for f in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("a file has rows in two tasks; deal rows by file before writing")
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if info.path.rstrip("/") != place(self.job)[1]:
                    (system.delete_dir if info.type == fs.FileType.Directory else system.delete_file)(info.path)
        for name, lies, *_ in files:
            system.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
            system.move(lies, f"{root}/{name}")
        if self.index:
            rows = [{"file": name, "rows": n, "bytes": size, "sha256": sha} for name, _, n, size, sha in files]
            with system.open_output_stream(f"{place(self.job)[1]}/index") as out:
                out.write((json.dumps(rows, ensure_ascii=False, indent=1) + "\n").encode())
            system.move(f"{place(self.job)[1]}/index", f"{root}/{self.index}")
        self.drop()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.drop()

    def drop(self) -> None:
        system, job = place(self.job)
        if system.get_file_info(job).type != fs.FileType.NotFound:
            system.delete_dir(job)


class NamedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "file string, piece string, n int"

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options, overwrite)


def save(rows: DataFrame, root: str, file: Column, piece: Column, order: list[str], open_: str = "[", close: str = "]", index: str = "index.json", mode: str = "append", n: Column | None = None) -> None:
    """A JSON file at root for each value of `file` (a relative path), its pieces in order, and the index of what was written.

    A piece is one row of the file, or `n` rows that are joined already. Files stream through sorted partitions, so one of any
    size takes the memory of a batch.
    """
    by_value(__name__)
    rows.sparkSession.dataSource.register(NamedJson)
    dealt = rows.select(file.alias("file"), piece.alias("piece"), (F.lit(1) if n is None else n).cast("int").alias("n"), *(F.col(o).alias(f"o{i}") for i, o in enumerate(order)))
    names = [f"o{i}" for i in range(len(order))]
    out = dealt.repartition("file").sortWithinPartitions("file", *names).select("file", "piece", "n")
    out.write.format(FORMAT).options(open=open_, close=close, index=index).option("path", root).mode(mode).save()


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.substring(F.to_json(F.array(text)), F.lit(2), F.length(F.to_json(F.array(text))) - 2)


#: Refs that are integers go into a file in runs: those that agree but for so many of their last bits, 8,192 verses at most.
RUN = 13


def publish_compact(verses: DataFrame, spine: DataFrame, root: str, index_root: str) -> None:
    """The compact files of each edition and book, and once for each book the lexemes of its verses.

    verses: iso, edition, book, book_hash, ref, compact; spine: book, ref, lexemes. A file is an array of one string for each verse
    of the book's index, empty where the edition has none, and is named <i>/<iso>/<edition>/<BOOK>_<hash>.json.
    """
    known = verses.where("iso IS NOT NULL AND edition IS NOT NULL")
    own = known.groupBy("book", "ref").agg(F.collect_list(F.struct("iso", "edition", "compact")).alias("editions"))
    publish_verses(spine.join(own, ["book", "ref"], "left"), verses.select("iso", "edition", "book", "book_hash").distinct(), root, index_root)


def publish_verses(verses: DataFrame, books: DataFrame, root: str, index_root: str) -> None:
    """The files of publish_compact from one row for each verse: book, ref, lexemes, and editions (iso, edition, compact; those
    that have it). books: iso, edition, book, book_hash.

    What grows with verses times editions are strings of runs of verses, not rows.
    """
    kind = verses.schema["ref"].dataType
    run = F.shiftright("ref", RUN) if isinstance(kind, IntegralType) else F.col("ref")
    text = lambda e: F.struct(F.struct(e["iso"], e["edition"]).alias("k"), F.when(F.coalesce(e["compact"], F.lit("")) == "", '""').otherwise(quoted(e["compact"])).alias("v"))
    cells = F.coalesce(F.transform("editions", text), F.array().cast("array<struct<k:struct<iso:string,edition:string>,v:string>>"))
    runs = verses.select("book", "ref", run.alias("run"), cells.alias("cells")).groupBy("book", "run").agg(F.array_sort(F.collect_list(F.struct("ref", "cells"))).alias("s"))
    runs = runs.select("book", "run", F.transform("s", lambda v: F.map_from_entries(v["cells"])).alias("s"))
    every = runs.join(books, "book").withColumn("k", F.struct("iso", "edition"))
    piece = F.array_join(F.transform("s", lambda v: F.coalesce(F.try_element_at(v, F.col("k")), F.lit('""'))), ", ")
    name = F.concat_ws("/", F.left("iso", F.lit(1)), "iso", "edition", F.concat(F.concat_ws("_", "book", "book_hash"), F.lit(".json")))
    save(every, root, name, piece, ["run"], n=F.size("s"))
    entry = F.concat(quoted(F.col("ref").cast("string")), F.lit(": "), F.to_json("lexemes"))
    own = verses.join(books.select("book").distinct(), "book", "left_semi").select("book", "ref", run.alias("run"), entry.alias("entry"))
    own = own.groupBy("book", "run").agg(F.array_sort(F.collect_list(F.struct("ref", "entry"))).alias("s"))
    save(own, index_root, F.concat("book", F.lit("_lexemes.json")), F.array_join(F.transform("s", lambda v: v["entry"]), ", "), ["run"], "{", "}", n=F.size("s"))


def index_of(spark: SparkSession, root: str, index: str = "index.json") -> DataFrame:
    """The index of what the last job wrote."""
    return spark.read.schema("file string, rows long, bytes long, sha256 string").json(f"{root}/{index}", multiLine=True)
