"""Folders of which readers see a whole write or nothing of it.

Data goes to a new folder each time; an empty file in ``_commits``, made last, says that the folder counts.  Its name
holds all there is to know: number, kind (``replace`` or ``append``), folder, batch.  Making one empty file is one step
on every file system and object store, so a job that fails half way leaves the table as it was, a table can be rebuilt
from itself, and the same batch counts once however often its job runs.  One writer at a time; readers need no care.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

_LOG = "_commits"


@dataclass(frozen=True)
class Commit:
    number: int
    kind: str
    folder: str
    batch: str


class CommitLog:
    """The commits below one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._place = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._place(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place = self._place(folder)
        return [s.getPath().getName() for s in self._files.listStatus(place)] if self._files.exists(place) else []

    def commits(self) -> list[Commit]:
        """All commits in order; of a batch that was committed twice the first."""
        found, batches = [], set()
        for name in sorted(self._names(f"{self.path}/{_LOG}")):
            number, kind, folder, batch = name.split(".")
            if batch not in batches:
                found.append(Commit(int(number), kind, folder, batch))
                batches.add(batch)
        return found

    def current(self) -> list[str]:
        """Folders that make up the table now: the last replacement and what was appended since; empty if there is none."""
        folders: list[str] = []
        for commit in self.commits():
            folders = [commit.folder] if commit.kind == "replace" else [*folders, commit.folder]
        return [f"{self.path}/{f}" for f in folders]

    def holds(self, batch: str) -> bool:
        return _token(batch) in {c.batch for c in self.commits()}

    def new_folder(self) -> str:
        """A name for data that is yet to be written and committed."""
        others = [n for n in self._names(self.path) if n != _LOG and not n.startswith("data-")]
        if others:
            raise ValueError(f"{self.path} holds files that were not committed, such as {others[0]}")
        return f"data-{uuid.uuid4().hex}"

    def commit(self, kind: str, folder: str, batch: str | None = None) -> None:
        number = max((c.number for c in self.commits()), default=0) + 1
        token = _token(batch) if batch is not None else uuid.uuid4().hex
        marker = self._place(f"{self.path}/{_LOG}/{number:012d}.{kind}.{folder}.{token}")
        self._files.create(marker, False).close()

    def vacuum(self) -> int:
        """Delete folders that are not part of the table, left by replacements and failed jobs; returns how many."""
        kept = {f.rsplit("/", 1)[1] for f in self.current()}
        gone = [n for n in self._names(self.path) if n.startswith("data-") and n not in kept]
        for name in gone:
            self._files.delete(self._place(f"{self.path}/{name}"), True)
        return len(gone)


def _token(batch: str) -> str:
    return hashlib.sha256(batch.encode()).hexdigest()[:32]
