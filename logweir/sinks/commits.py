"""Which files of the pipeline's tables count: one commit for each micro-batch, across all tables.

A batch writes its rows of every table into folders of its own, and last of all one small manifest
that names them. A manifest appears at once or not at all, and readers take only what manifests
name, so all tables of a snapshot stand at the same batches however a batch ended. A batch that
has its manifest is never stored again: batches are counted within a run, the identity that
Structured Streaming keeps in a checkpoint.

Folding merges what batches have left: small files of a day become larger ones, additive metric
rows become totals. It names the files of each day in one manifest of its own and up to which
batch of each run they go; manifests of those batches are then removed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.sinks.tables import DAY, day_of

#: The folder of one write below a table; also a column, so that folders of all writes go together.
WRITE = "write"
_LOST = "more than one writer of one run: "


@dataclass(frozen=True)
class Commit:
    run: str
    batch: int
    files: dict[str, list[str]]
    note: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.run}-{self.batch:020d}.json"


@dataclass(frozen=True)
class Fold:
    """``upto``: the last batch of each run; ``files``: by table and day; ``note``: of the last batch of each run."""

    number: int = 0
    upto: dict[str, int] = field(default_factory=dict)
    files: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    note: dict[str, dict] = field(default_factory=dict)


class Ledger:
    """Manifests below ``root``, which is storage that driver and executors share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop, self._conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._hadoop.Path("/".join([self.root, *parts]))

    def _list(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        fs = path.getFileSystem(self._conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _get(self, *parts: str) -> dict:
        path = self._path(*parts)
        stream = path.getFileSystem(self._conf).open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put(self, content: dict, *parts: str) -> None:
        """A file that is there whole or not at all; an error if it is there already."""
        final, scratch = self._path(*parts), self._path(*parts[:-1], f".{uuid.uuid4()}")
        fs = final.getFileSystem(self._conf)
        stream = fs.create(scratch, False)
        stream.write(json.dumps(content).encode())
        stream.close()
        if fs.exists(final) or not fs.rename(scratch, final):
            fs.delete(scratch, False)
            raise FileExistsError(_LOST + "/".join(parts))

    def write(self, table: str, rows: DataFrame, time_col: str, name: str) -> list[str]:
        """Write rows by day into a folder of their own; the folders that hold any, relative to the table."""
        place = f"{WRITE}={name}-{uuid.uuid4().hex[:8]}"
        rows.withColumn(DAY, day_of(F.col(time_col))).write.partitionBy(DAY).parquet(f"{self.root}/{table}/{place}")
        return [f"{place}/{d}" for d in self._list(table, place) if d.startswith(f"{DAY}=")]

    def is_committed(self, run: str, batch: int) -> bool:
        return batch <= self.last_fold().upto.get(run, -1) or Commit(run, batch, {}).name in self._list("_commits")

    def commit(self, run: str, batch: int, files: dict[str, list[str]], note: dict | None = None) -> None:
        commit = Commit(run, batch, files, note or {})
        self._put({"run": run, "batch": batch, "files": files, "note": commit.note}, "_commits", commit.name)

    def last_fold(self) -> Fold:
        names = [n for n in self._list("_folds") if re.fullmatch(r"\d+\.json", n)]
        return Fold(**self._get("_folds", names[-1])) if names else Fold()

    def snapshot(self) -> Snapshot:
        """What is committed now. Batches that are folded meanwhile are seen once, in either place."""
        while True:
            fold, names = self.last_fold(), [n for n in self._list("_commits") if n.endswith(".json")]
            try:
                commits = [Commit(**self._get("_commits", n)) for n in names]
            except Exception:
                if self.last_fold().number == fold.number:
                    raise
                continue  # a fold has removed some since
            return Snapshot(self, fold, [c for c in commits if c.batch > fold.upto.get(c.run, -1)])

    def fold(self, seen: Snapshot, files: dict[str, dict[str, list[str]]]) -> None:
        """Let ``files`` (by table and day) stand for all that ``seen`` saw."""
        upto, note = dict(seen.fold.upto), dict(seen.fold.note)
        for c in sorted(seen.commits, key=lambda c: c.batch):
            upto[c.run], note[c.run] = c.batch, c.note
        number = seen.fold.number + 1
        self._put({"number": number, "upto": upto, "files": files, "note": note}, "_folds", f"{number:020d}.json")
        for c in seen.commits:
            path = self._path("_commits", c.name)
            path.getFileSystem(self._conf).delete(path, False)


@dataclass(frozen=True)
class Snapshot:
    ledger: Ledger
    fold: Fold
    commits: list[Commit]

    def _read(self, table: str, schema: T.StructType, paths: Iterable[str]) -> DataFrame:
        full = T.StructType([*schema.fields, T.StructField(WRITE, T.StringType()), T.StructField(DAY, T.DateType())])
        base, spark = f"{self.ledger.root}/{table}", self.ledger.spark
        places = sorted({f"{base}/{p}" for p in paths})
        found = spark.read.schema(full).option("basePath", base).parquet(*places) if places else spark.createDataFrame([], full)
        return found.drop(WRITE)

    def days(self, table: str) -> set[str]:
        """Days of a table that batches since the last fold have rows of."""
        return {p.rpartition("=")[2] for c in self.commits for p in c.files.get(table, [])}

    def since_fold(self, table: str, schema: T.StructType) -> DataFrame:
        return self._read(table, schema, (p for c in self.commits for p in c.files.get(table, [])))

    def folded(self, table: str, schema: T.StructType, days: Iterable[str] | None = None) -> DataFrame:
        by_day = self.fold.files.get(table, {})
        chosen = by_day if days is None else [d for d in by_day if d in set(days)]
        return self._read(table, schema, (p for d in chosen for p in by_day[d]))

    def table(self, table: str, schema: T.StructType, first: date | None = None, last: date | None = None) -> DataFrame:
        """Rows of all committed batches, with ``day``; only folders of the days asked for are listed."""
        paths = [p for c in self.commits for p in c.files.get(table, [])]
        paths += [p for ps in self.fold.files.get(table, {}).values() for p in ps]
        low, high = str(first or date.min), str(last or date.max)
        return self._read(table, schema, (p for p in paths if low <= p.rpartition("=")[2] <= high))

    def note(self, run: str) -> dict:
        """What the last batch of a run has left as its note."""
        own = [c for c in self.commits if c.run == run]
        return max(own, key=lambda c: c.batch).note if own else self.fold.note.get(run, {})
