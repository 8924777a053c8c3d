"""A data source for trees of folders, root/language/section/folder/file: one row a file.

Folders are listed once, when the scan is planned. Filters on language and
section that Spark pushes down choose the folders that are listed and opened at
all; the files found are dealt into partitions. A file that can't be read or is
no UTF-8 is a row with an error instead of a text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

SCHEMA = "language string, section string, folder string, path string, text string, error string"
#: Files of a partition.
FILES = 256


@dataclass
class Files(InputPartition):
    """Paths that one task reads."""

    paths: list[str]


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def _folders(store: fs.FileSystem, path: str) -> list[str]:
    found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and f.base_name[:1] not in "._")


class TreeReader(DataSourceReader):
    """Plans and reads a tree; ``allowed`` holds the values that a level may have, where a filter says so."""

    def __init__(self, options: dict[str, str]):
        self.root, self.name = options["path"], options["file"]
        sections = options.get("sections")
        self.allowed: dict[str, set[str]] = {"section": set(json.loads(sections))} if sections else {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            values = {EqualTo: lambda x: (x.value,), In: lambda x: x.value}.get(type(f))
            level = f.attribute[0] if values and len(f.attribute) == 1 else None
            if level in ("language", "section"):
                wanted = set(values(f))
                self.allowed[level] = self.allowed[level] & wanted if level in self.allowed else wanted
            else:
                yield f

    def _listed(self, store: fs.FileSystem, path: str, level: str) -> list[str]:
        """Folders of a level: known names are looked for, and nothing else is opened."""
        found = _folders(store, path)
        return found if level not in self.allowed else [x for x in found if x in self.allowed[level]]

    def partitions(self) -> list[Files]:
        store, top = _opened(self.root)
        paths = []
        for language in self._listed(store, top, "language"):
            for section in self._listed(store, f"{top}/{language}", "section"):
                paths += [f"{language}/{section}/{x}" for x in _folders(store, f"{top}/{language}/{section}")]
        return [Files(paths[i : i + FILES]) for i in range(0, len(paths), FILES)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, top = _opened(self.root)
        for where in partition.paths:
            path, text, error = f"{top}/{where}/{self.name}", None, None
            try:
                with store.open_input_stream(path) as stream:
                    text = stream.read().decode()
            except FileNotFoundError:
                continue
            except (OSError, UnicodeDecodeError) as e:
                error = type(e).__name__
            yield pa.RecordBatch.from_pylist([dict(zip(("language", "section", "folder", "path", "text", "error"), (*where.split("/"), path, text, error), strict=True))], pa.schema([(c, pa.string()) for c in ("language", "section", "folder", "path", "text", "error")]))


class TreeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lectern_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TreeReader:
        return TreeReader(dict(self.options))


def read_tree(spark: SparkSession, root: str, file: str, sections: list[str] | None = None) -> DataFrame:
    """(language, section, folder, path, text, error) of each file at root/language/section/folder; sections: the only ones that are visited."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TreeSource)
    reader = spark.read.format("lectern_tree").option("file", file)
    return (reader.option("sections", json.dumps(sections)) if sections else reader).load(root)


def keyed_records(tree: DataFrame, schema: str, key: str) -> DataFrame:
    """Records of a tree's JSON files with the folder's name: the dimension that others refer to by key, and rows without one left out."""
    from pyspark.sql import functions as F

    parsed = tree.where("text is not null").select("folder", "path", F.from_json("text", schema).alias("_v"))
    return parsed.select("_v.*", F.col("folder").alias("in_folder")).where(F.col(key).isNotNull())


def write_tree(df: DataFrame, root: str, file: str) -> None:
    """Lands rows (language, section, folder, text) as a tree; a task that runs again writes the same files."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _opened(root)
        n = 0
        for batch in batches:
            for row in batch.to_pylist():
                path = f"{top}/{row['language']}/{row['section']}/{row['folder']}"
                store.create_dir(path, recursive=True)
                with store.open_output_stream(f"{path}/{file}") as out:
                    out.write((row["text"] or "").encode())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]}, pa.schema([("n", pa.int64())]))

    df.select("language", "section", "folder", "text").mapInArrow(work, "n long").agg({"n": "sum"}).collect()
