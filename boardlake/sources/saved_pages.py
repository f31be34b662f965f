"""A data source for folders of saved pages: `spark.read.format("saved_pages")`, one folder for each board.

A condition on the board reaches the source, so pages of other boards are neither listed nor opened. Files are dealt to tasks
by their sizes, about `split` bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from boardlake.functions.scratch import arrow_files


@dataclass
class Pages(InputPartition):
    files: list[tuple[str, str]] = field(default_factory=list)


class Reader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split, self.boards = path, split, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("board",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.boards = wanted if self.boards is None else self.boards & wanted
            else:
                yield f

    def partitions(self) -> list[Pages]:
        files, root = arrow_files(self.path)
        boards = [i.base_name for i in files.get_file_info(fs.FileSelector(root)) if i.type == fs.FileType.Directory]
        out, size = [Pages()], 0
        for board in sorted(b for b in boards if self.boards is None or b in self.boards):
            found = files.get_file_info(fs.FileSelector(f"{root}/{board}", recursive=True))
            for info in sorted((i for i in found if i.is_file and i.base_name.rpartition(".")[2].startswith("htm")), key=lambda i: i.path):
                if size + info.size > self.split and out[-1].files:
                    out.append(Pages())
                    size = 0
                out[-1].files.append((board, info.path))
                size += info.size
        return out

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        files, _ = arrow_files(self.path)
        for board, path in partition.files:
            with files.open_input_stream(path) as page:
                text = page.read().decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (path, board, text)], names=["file", "board", "page"])


class SavedPages(DataSource):
    """Options: path, a folder with a folder for each board, and split, the bytes of a task (16 MiB)."""

    @classmethod
    def name(cls) -> str:
        return "saved_pages"

    def schema(self) -> str:
        return "file string, board string, page string"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], int(self.options.get("split", 16 << 20)))


def register(spark: SparkSession) -> None:
    """Makes the source known to a session, and lets the session hand conditions to sources of this kind."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SavedPages)
