"""Commits of a folder of tables: which parts of each are to be read, as a numbered list of small files.

Parts are written under new names and count only once a commit names them, so all that a commit names becomes visible at
once; what a stopped run left is never read, and `sweep` deletes it.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass
class Commits:
    spark: SparkSession
    folder: str

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._files().listStatus(path)) if self._files().exists(path) else []

    def latest(self) -> tuple[int, dict]:
        """The number and content of the last commit; (0, {}) before the first."""
        names = [n for n in self._names(f"{self.folder}/commits") if n.endswith(".json")]
        if not names:
            return 0, {}
        text = "".join(r.value for r in self.spark.read.text(f"{self.folder}/commits/{names[-1]}", wholetext=True).collect())
        return int(names[-1].removesuffix(".json")), json.loads(text)

    def commit(self, content: dict, after: int) -> None:
        """Makes content the commit that follows `after`; an error if another writer was first."""
        files, draft = self._files(), self._path(f"{self.folder}/commits/_draft-{uuid.uuid4().hex}")
        out = files.create(draft)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        target = self._path(f"{self.folder}/commits/{after + 1:08d}.json")
        if files.exists(target) or not files.rename(draft, target):
            files.delete(draft, False)
            raise RuntimeError(f"another writer made commit {after + 1} of {self.folder}")

    def new_part(self, table: str) -> str:
        """The path for a part that no commit names yet."""
        return f"{self.folder}/{table}/{uuid.uuid4().hex}"

    def size(self, path: str) -> int:
        return self._files().getContentSummary(self._path(path)).getLength()

    def delete(self, path: str) -> None:
        self._files().delete(self._path(path), True)

    def sweep(self, tables: list[str], keep: set[str]) -> int:
        """Deletes the parts of these tables that are not among `keep`, and says how many. Not while others write or read older commits."""
        gone = [p for t in tables for n in self._names(f"{self.folder}/{t}") if (p := f"{self.folder}/{t}/{n}") not in keep]
        for p in gone:
            self.delete(p)
        return len(gone)
