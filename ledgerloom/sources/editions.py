"""Folders of editions as a data source: spark.read.format("editions") gives blocks, df.write.format("editions") one JSON file per document.

Reading: the folder is listed once, on the driver; files go to tasks in runs of about `bytesPerTask`, and a task parses its files one
by one, so it holds one document at a time. Equality and `in` on doc_id, page, role and noise are taken over from Spark
(set spark.sql.python.filterPushdown.enabled), so blocks of other pages are never handed on.

Writing: rows have a name and JSON text. Tasks write below `_staging`; the commit moves the files of successful tasks to their
places, and an abort removes the staging folder. A failed or repeated task leaves nothing readers see. Readers skip names
that begin with `_` or `.`.

Files are reached by pyarrow's file systems, so a path may be a local one or a URI that they know.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import Row, StructType

BLOCKS = "doc_id string, page int, ord int, block_id string, text string, role string, noise boolean"
_ARROW = pa.schema([("doc_id", pa.string()), ("page", pa.int32()), ("ord", pa.int32()), ("block_id", pa.string()), ("text", pa.string()), ("role", pa.string()), ("noise", pa.bool_())])
FILTERED = ("doc_id", "page", "role", "noise")
BYTES_PER_TASK = 64 << 20
ENDS = re.compile(r"^\s+|\s+$")


def _reach(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    """A run of files of about one size."""

    paths: list[str]


class EditionReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.size = int(options.get("bytesPerTask", BYTES_PER_TASK))
        self.wanted: dict[str, list[set]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in FILTERED:
                self.wanted.setdefault(f.attribute[0], []).append(set(f.value) if isinstance(f, In) else {f.value})
            else:
                yield f

    def partitions(self) -> list[Files]:
        system, path = _reach(self.path)
        found = sorted(system.get_file_info(fs.FileSelector(path, recursive=True)), key=lambda x: x.path)
        files = [x for x in found if x.is_file and x.path.endswith(".json") and not any(p[:1] in "_." for p in x.path[len(path) :].strip("/").split("/"))]
        runs: list[Files] = []
        held = 0
        for x in files:
            if not runs or held + x.size > self.size:
                runs.append(Files([]))
                held = 0
            runs[-1].paths.append(x.path)
            held += x.size
        return runs or [Files([])]

    def keeps(self, name: str, value: Any) -> bool:
        return all(value in values for values in self.wanted.get(name, []))

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _reach(self.path)
        for path in partition.paths:
            with system.open_input_stream(path) as file:
                document = json.loads(file.read())
            rows = list(self.blocks(document))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    def blocks(self, document: dict) -> Iterator[dict]:
        doc_id = (document.get("source") or {}).get("sha256")
        if not self.keeps("doc_id", doc_id):
            return
        for page in document.get("pages") or []:
            if not self.keeps("page", page.get("number")):
                continue
            for block in page.get("blocks") or []:
                role, noise = block.get("markdown_role") or "paragraph", bool(block.get("removed_as_noise"))
                if self.keeps("role", role) and self.keeps("noise", noise):
                    yield {"doc_id": doc_id, "page": page.get("number"), "ord": block.get("order"), "block_id": block.get("id"), "text": ENDS.sub("", block.get("text_normalized") or ""), "role": role, "noise": noise}


@dataclass
class Written(WriterCommitMessage):
    """Names of a task's files in its staging folder."""

    folder: str
    names: list[str]


class EditionWriter(DataSourceWriter):
    """Rows of (name, JSON text): one file each; indented if the option pretty is true."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.pretty = options.get("pretty", "false").lower() == "true"
        self.staging = f"_staging/{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> Written:
        system, path = _reach(self.path)
        folder = f"{path}/{self.staging}/{uuid.uuid4().hex}"
        system.create_dir(folder, recursive=True)
        names = []
        for name, text in iterator:
            if not re.fullmatch(r"[^/\\._][^/\\]*", str(name)):
                raise ValueError(f"not a file name: {name!r}")
            body = json.dumps(json.loads(text), ensure_ascii=False, indent=2 if self.pretty else None, separators=None if self.pretty else (",", ":"))
            with system.open_output_stream(f"{folder}/{name}.json") as file:
                file.write(body.encode() + b"\n")
            names.append(f"{name}.json")
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, path = _reach(self.path)
        done = [m for m in messages if m]
        names = [n for m in done for n in m.names]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("two documents have one name")
        there = [x.path for x in system.get_file_info(fs.FileSelector(path)) if x.is_file and x.path.endswith(".json")] if self.overwrite else []
        for m in done:
            for name in m.names:
                system.move(f"{m.folder}/{name}", f"{path}/{name}")
        for old in there:
            if old.rpartition("/")[2] not in names:
                system.delete_file(old)
        self._forget(system, path)

    def abort(self, messages: list[Written | None]) -> None:
        self._forget(*_reach(self.path))

    def _forget(self, system: fs.FileSystem, path: str) -> None:
        if system.get_file_info(f"{path}/{self.staging}").type == fs.FileType.Directory:
            system.delete_dir(f"{path}/{self.staging}")


class EditionSource(DataSource):
    """options: path; bytesPerTask (reading), pretty (writing)."""

    @classmethod
    def name(cls) -> str:
        return "editions"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema: StructType) -> EditionReader:
        return EditionReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> EditionWriter:
        if len(schema.fields) != 2:
            raise ValueError("rows of a name and a JSON text are written")
        return EditionWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it take over filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EditionSource)
