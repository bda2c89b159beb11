"""Tables by period whose state is one small pointer file: a write is seen whole or not at all.

A write puts its periods into a version folder of its own and then renames one pointer file into place, which
names for every period the version that holds it. Readers resolve the newest pointer first and read exactly the folders
it names, so a write that dies at any point before the rename leaves every reader with the old rows, and
one that ends replaces all of its periods at once. Pointers are numbered, and a rename never replaces a file: of two
writers that started from one state the second finds its number taken and builds on the new state, or stops if the
first published a period of its own.

    <table>/_state/000000000007.json    {"ret_period=062000": "version=3f..."}
    <table>/version=3f.../ret_period=062000/part-....parquet
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from returns_analytics.errors import PublishConflict
from returns_analytics.sources.files import Folder

_PERIOD = "ret_period"


@dataclass(frozen=True)
class State:
    """What a pointer says: its number (0: nothing published yet) and the version of each partition folder."""

    number: int
    versions: dict[str, str]


@dataclass(frozen=True)
class Published:
    """A table below one folder, partitioned by ret_period."""

    spark: SparkSession
    path: str

    @property
    def _folder(self) -> Folder:
        return Folder(self.spark, self.path)

    def state(self) -> State:
        names = [name for name in self._folder.names("_state") if name.endswith(".json")]
        if not names:
            return State(0, {})
        newest = max(names)
        return State(int(newest.removesuffix(".json")), json.loads(self._folder.read(f"_state/{newest}")))

    def read(self, columns: T.StructType, periods: Iterable[str] | None = None) -> DataFrame:
        """The rows of the newest state, or of some of its periods; an empty table before the first write."""
        versions = self.state().versions
        wanted = versions if periods is None else {f"{_PERIOD}={p}" for p in periods} & set(versions)
        if not wanted:
            return self.spark.createDataFrame([], columns)
        folders = [f"{self.path}/{versions[name]}/{name}" for name in sorted(wanted)]
        return self.spark.read.schema(columns).option("basePath", self.path).parquet(*folders).select(*columns.names)

    def publish(self, table: DataFrame, periods: Iterable[str] = ()) -> State:
        """Replace the periods the table holds, and remove those of ``periods`` it has no row of. Eager.

        The rebalance hint lets AQE split a big period over many tasks and put small ones together, so files
        come out near the advisory size whatever the periods hold. The table may read from this one: nothing
        that a reader sees is touched.
        """
        base, version = self.state(), f"version={uuid.uuid4().hex}"
        try:
            table.hint("rebalance", _PERIOD).write.partitionBy(_PERIOD).parquet(f"{self.path}/{version}")
            written = {name: version for name in self._folder.names(version) if name.startswith(f"{_PERIOD}=")}
            gone = {f"{_PERIOD}={p}" for p in periods} - set(written)
            return self._point(base, written, gone)
        except BaseException:
            self._folder.delete(version)
            raise

    def _point(self, base: State, written: dict[str, str], gone: set[str]) -> State:
        while True:
            now = self.state()
            moved = [name for name in {*written, *gone} if now.versions.get(name) != base.versions.get(name)]
            if moved:
                raise PublishConflict(f"another run published {sorted(moved)} of {self.path} meanwhile")
            versions = {name: v for name, v in now.versions.items() if name not in gone} | written
            state = State(now.number + 1, versions)
            if self._folder.create(f"_state/{state.number:012d}.json", json.dumps(versions, sort_keys=True)):
                return state

    def clean(self, keep: int = 1) -> list[str]:
        """Remove pointers but the newest ``keep``, and the versions only removed pointers name.

        Versions no pointer ever named, those of writes under way or lost, are left alone. Readers of a removed
        state must be done.
        """
        numbers = sorted(int(n.removesuffix(".json")) for n in self._folder.names("_state") if n.endswith(".json"))
        read = lambda n: json.loads(self._folder.read(f"_state/{n:012d}.json")).values()
        old, kept = numbers[:-keep], numbers[-keep:]
        needed = {version for number in kept for version in read(number)}
        unused = sorted({version for number in old for version in read(number)} - needed)
        for number in old:
            self._folder.delete(f"_state/{number:012d}.json")
        for version in unused:
            self._folder.delete(version)
        return unused
