"""A journal of committed files: what a run has finished, batch by batch.

An entry is a small file that names a folder of results; it is written beside and renamed, so it is there whole
or not at all, and readers take files from entries alone. Entries belong to a generation. A new one is
begun to replace all that is there; until it is finished, readers see the one before, and a run that finds it
unfinished goes on with it. An entry may replace earlier ones of its kind, which are void from then on and
whose files are removed after it is there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sources.readers import exists


@dataclass(frozen=True)
class Entry:
    generation: int
    number: int
    kind: str
    path: str
    #: What it was made from.
    inputs: str = ""
    #: How many entries it stands for; two of the same weight are merged.
    weight: int = 1
    replaces: list[int] = field(default_factory=list)


class Journal:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = f"{self.root}/journal"

    def _path(self, path: str):
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _put(self, name: str, text: str) -> None:
        beside, store = self._path(f"{self.folder}/.{name}-{uuid.uuid4().hex}")
        out = store.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not store.rename(beside, self._path(f"{self.folder}/{name}")[0]):
            raise FileExistsError(f"{self.folder}/{name}")

    def all(self) -> list[Entry]:
        """Entries that count, in order."""
        if not exists(self.spark, self.folder):
            return []
        lines = self.spark.read.text(self.folder, pathGlobFilter="*.entry").collect()
        found = sorted((Entry(**json.loads(r.value)) for r in lines), key=lambda e: (e.generation, e.number))
        void = {(e.generation, n) for e in found for n in e.replaces}
        return [e for e in found if (e.generation, e.number) not in void]

    def finished(self) -> int:
        """The generation that readers see; 0 if none is finished."""
        return self._last("finished")

    def _last(self, ending: str) -> int:
        if not exists(self.spark, self.folder):
            return 0
        where, store = self._path(f"{self.folder}/*.{ending}")
        return max((int(f.getPath().getName().split(".")[0].split("-")[0]) for f in store.globStatus(where) or ()), default=0)

    def begin(self, anew: bool) -> int:
        """The generation to work in: one that a run has left unfinished, else a new one if asked for or there is none."""
        done, last = self.finished(), self._last("begun")
        if last > done:
            return last
        if done and not anew:
            return done
        self._put(f"{done + 1:06d}.begun", "")
        return done + 1

    def add(self, generation: int, kind: str, path: str, inputs: str = "", weight: int = 1, replaces: list[Entry] | None = None) -> Entry:
        """Make a folder of results count; the files of what it replaces go then."""
        entry = Entry(generation, self._next(generation), kind, path, inputs, weight, [e.number for e in replaces or ()])
        self._put(f"{generation:06d}-{entry.number:08d}.entry", json.dumps(asdict(entry)))
        for old in replaces or ():
            self.remove(old.path)
        return entry

    def _next(self, generation: int) -> int:
        where, store = self._path(f"{self.folder}/{generation:06d}-*.entry")
        return 1 + max((int(f.getPath().getName().split(".")[0].split("-")[1]) for f in store.globStatus(where) or ()), default=0)

    def finish(self, generation: int) -> None:
        """Let readers see a generation; what earlier ones have is removed."""
        if self.finished() < generation:
            old = [e for e in self.all() if e.generation < generation]
            self._put(f"{generation:06d}.finished", "")
            for e in old:
                self.remove(e.path)

    def entries(self, kind: str, generation: int | None = None) -> list[Entry]:
        own = self.finished() if generation is None else generation
        return [e for e in self.all() if e.generation == own and e.kind == kind]

    def read(self, kind: str, schema: str, generation: int | None = None) -> DataFrame:
        """Rows of all entries of a kind."""
        paths = [e.path for e in self.entries(kind, generation)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def fresh(self, kind: str) -> str:
        """A folder for results that don't count yet."""
        return f"{self.root}/{kind}/{uuid.uuid4().hex}"

    def fold(self, generation: int, kind: str, schema: str) -> None:
        """One folder in place of those that a run's batches have written."""
        parts = [e for e in self.entries(kind, generation) if e.weight == 1]
        if len(parts) > 1:
            path = self.fresh(kind)
            self.spark.read.schema(schema).parquet(*(e.path for e in parts)).write.parquet(path)
            self.add(generation, kind, path, weight=len(parts), replaces=parts)

    def remove(self, path: str) -> None:
        where, store = self._path(path)
        store.delete(where, True)
