"""Trees of page files (`layer/page_001.txt`) as a data source: read by bytes from one listing, written with commits of tasks."""

from __future__ import annotations

import contextlib
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = "layer string, page int, size long, content binary"
NAME = re.compile(r"page_(\d+)\.txt\Z")
#: Bytes of files in a partition; files are never split.
PARTITION_BYTES = 32 << 20
#: Rows and bytes in one batch.
BATCH, BATCH_BYTES = 1024, 8 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path within it."""
    return fs.FileSystem.from_uri(path) if re.match(r"\w+:", path) else (fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    files: list[tuple[str, str, int, int]]


@dataclass
class Drafts(WriterCommitMessage):
    """Where a task's drafts are, and of each layer the pages, compressed: a draft's name follows from its page, so a file costs the driver a few bytes."""

    task: str
    pages: dict[str, bytes] = field(default_factory=dict)

    def moves(self, root: str) -> Iterator[tuple[str, str]]:
        for layer, packed in self.pages.items():
            for page in array("i", zlib.decompress(packed)):
                yield draft_name(root, layer, self.task, page), f"{root.rstrip('/')}/{layer}/page_{page:03d}.txt"


def draft_name(root: str, layer: str, task: str, page: int) -> str:
    return f"{root.rstrip('/')}/{layer}/.draft-{task}-{page}"


class PageTree(DataSource):
    """Options: path; layers, comma-separated (all); content=false for names and sizes alone."""

    @classmethod
    def name(cls) -> str:
        return "page_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return Reader(self.options)

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return Writer(self.options["path"], overwrite)


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.content = options["path"], options.get("content", "true") != "false"
        self.layers = [x for x in options.get("layers", "").split(",") if x]
        self.limit = int(options.get("partitionBytes", PARTITION_BYTES))

    def partitions(self) -> list[Files]:
        system, root = opened(self.path)
        found = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            rest = info.path[len(root) :].strip("/").split("/")
            named = NAME.fullmatch(rest[-1])
            if info.type == fs.FileType.File and len(rest) == 2 and named and int(named[1]) < 1 << 31 and (not self.layers or rest[0] in self.layers):
                found.append((info.path, rest[0], int(named[1]), info.size))
        out, held = [], 0
        for f in sorted(found):
            if not out or self.content and held + f[3] > self.limit or len(out[-1].files) >= 1 << 16:
                out.append(Files([]))
                held = 0
            out[-1].files.append(f)
            held += f[3]
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = opened(self.path)
        rows, held = [], 0
        for path, layer, page, size in partition.files:
            content = None
            if self.content:
                with system.open_input_stream(path) as f:
                    content = f.read()
            rows.append((layer, page, size, content))
            held += size if self.content else 0
            if len(rows) >= BATCH or held >= BATCH_BYTES:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["layer", "page", "size", "content"])


class Writer(DataSourceArrowWriter):
    """Each task writes drafts under names that no reader takes; the driver gives them their names once all tasks are done."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Drafts:
        system, root = opened(self.path)
        done, pages = Drafts(uuid.uuid4().hex), {}
        try:
            for batch in iterator:
                for r in batch.select(["layer", "page", "content"]).to_pylist():
                    layer, page = r["layer"], r["page"]
                    if layer not in pages:
                        system.create_dir(f"{root.rstrip('/')}/{layer}", recursive=True)
                        pages[layer] = set()
                    if page in pages[layer]:
                        raise ValueError("two rows for one page of a layer")
                    pages[layer].add(page)
                    with system.open_output_stream(draft_name(root, layer, done.task, page)) as f:
                        f.write(r["content"] or b"")
        finally:
            done.pages = {layer: zlib.compress(array("i", sorted(own)).tobytes()) for layer, own in pages.items()}
            if sys.exc_info()[0]:
                self.abort([done])
        return done

    def commit(self, messages: list[Drafts | None]) -> None:
        system, root = opened(self.path)
        pages: dict[str, set[int]] = {}
        for m in messages:
            for layer, packed in m.pages.items() if m else ():
                own = array("i", zlib.decompress(packed))
                if not pages.setdefault(layer, set()).isdisjoint(own):
                    self.abort(messages)
                    raise ValueError("two rows for one page of a layer")
                pages[layer].update(own)
        for m in messages:
            for draft, name in m.moves(root) if m else ():
                system.move(draft, name)
        if self.overwrite:
            for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
                named = NAME.search(info.path)
                if info.type == fs.FileType.File and named and not (int(named[1]) in pages.get(info.path.split("/")[-2], ()) and named[0] == f"page_{int(named[1]):03d}.txt"):
                    system.delete_file(info.path)

    def abort(self, messages: list[Drafts | None]) -> None:
        system, root = opened(self.path)
        for m in messages:
            for draft, _ in m.moves(root) if m else ():
                with contextlib.suppress(FileNotFoundError):
                    system.delete_file(draft)


def read(spark: SparkSession, path: str, layers: tuple[str, ...] = (), content: bool = True) -> DataFrame:
    """(layer, page, size, content) of all page files of a tree, from one listing."""
    spark.dataSource.register(PageTree)
    return spark.read.format("page_tree").option("path", path).option("layers", ",".join(layers)).option("content", str(content).lower()).load()


def write(pages: DataFrame, path: str, mode: str = "append") -> None:
    """Writes pages (layer, page, content) as files; mode overwrite removes all other page files."""
    pages.sparkSession.dataSource.register(PageTree)
    rows = pages.select(F.col("layer").cast("string").alias("layer"), F.col("page").cast("int").alias("page"), F.octet_length("content").cast("long").alias("size"), F.col("content").cast("binary").alias("content"))
    rows.write.format("page_tree").option("path", path).mode(mode).save()


def furthest(files: DataFrame, stages: tuple[str, ...], total: int, least: int = 10) -> DataFrame:
    """(page, status) of pages 1..total: the last of the stages whose file (layer, page, size) is larger than least bytes, else pending."""
    rank: Column = F.coalesce(*[F.when((F.col("layer") == s) & (F.col("size") > least), F.lit(k)) for k, s in enumerate(stages)])
    best = files.groupBy("page").agg(F.max(rank).alias("rank"))
    spine = files.sparkSession.range(1, total + 1).select(F.col("id").cast("int").alias("page"))
    return spine.join(best, "page", "left").select("page", F.coalesce(F.get(F.array(*map(F.lit, stages)), F.col("rank")), F.lit("pending")).alias("status"))
