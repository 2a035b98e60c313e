"""Which folders make up a state: a list of parts per version, written last, in one step.

Tables are written to fresh folders that nobody reads until a version names them. A version is one small file,
moved into place when it is complete, so a reader sees all tables of a batch or none, and what a job
that ended early has left behind is in no version. Readers keep what they have read: a version's folders
stay until ``vacuum`` finds them in none of the versions kept. A state has one writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from uuid import uuid4

from pyspark.sql import SparkSession

KEPT_VERSIONS = 10


@dataclass(frozen=True)
class Part:
    """Some rows of a table: a folder under the root, the last batch in it, and the number of rows."""

    table: str
    folder: str
    batch: int
    rows: int


@dataclass(frozen=True)
class Snapshot:
    version: int = -1
    settings: dict = field(default_factory=dict)
    parts: tuple[Part, ...] = ()

    def of(self, table: str) -> list[Part]:
        return [part for part in self.parts if part.table == table]

    def last_batch(self, table: str) -> int:
        return max((part.batch for part in self.of(table)), default=-1)

    def changed(self, added: list[Part], removed: list[Part] = ()) -> Snapshot:
        """The next version."""
        kept = tuple(part for part in self.parts if part not in removed)
        return replace(self, version=self.version + 1, parts=kept + tuple(added))


class Snapshots:
    """The versions of the state under ``root``, on any file system that Spark's tables can be on."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._text = spark._jvm.org.apache.commons.io.IOUtils
        self._files = self._hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *names: str):
        return self._hadoop.Path("/".join([self.root, *names]))

    def versions(self) -> list[int]:
        folder = self._path("versions")
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json"))

    def read(self, version: int | None = None) -> Snapshot:
        """A version, the last one by default; without any an empty state."""
        if version is None:
            found = self.versions()
            if not found:
                return Snapshot()
            version = found[-1]
        stream = self._files.open(self._path("versions", f"{version}.json"))
        try:
            values = json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Snapshot(version, values["settings"], tuple(Part(**part) for part in values["parts"]))

    def commit(self, snapshot: Snapshot) -> Snapshot:
        """Make the snapshot the last version; an error if there is one of its number."""
        final, draft = self._path("versions", f"{snapshot.version}.json"), self._path("versions", f"{uuid4().hex}.draft")
        stream = self._files.create(draft, True)
        stream.write(bytearray(json.dumps({"settings": snapshot.settings, "parts": [asdict(part) for part in snapshot.parts]}).encode()))
        stream.close()
        if self._files.exists(final) or not self._files.rename(draft, final):
            self._files.delete(draft, False)
            raise RuntimeError(f"{self.root}: another writer has made version {snapshot.version}")
        for old in self.versions()[:-KEPT_VERSIONS]:
            self._files.delete(self._path("versions", f"{old}.json"), False)
        return snapshot

    def new_folder(self, table: str) -> str:
        """A folder, under the root, that no part uses."""
        return f"{table}/{uuid4().hex}"

    def vacuum(self) -> list[str]:
        """Delete folders that no kept version names, of merged runs and of batches that ended early; returns them."""
        named = {part.folder for version in self.versions() for part in self.read(version).parts}
        gone = []
        for table in self._files.listStatus(self._path()) if self.versions() else []:
            if table.getPath().getName() in ("versions", "progress") or not table.isDirectory():
                continue
            for folder in self._files.listStatus(table.getPath()):
                name = f"{table.getPath().getName()}/{folder.getPath().getName()}"
                if name not in named:
                    self._files.delete(folder.getPath(), True)
                    gone.append(name)
        return gone
