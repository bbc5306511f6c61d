"""Stages of a flow that a later run goes on from.

A stage is a table under the flow's folder. Its name on disk holds a fingerprint of
what it is made from: its name, version and parameters, the files of the tables it
reads (path, size, time), and the fingerprints of the stages it reads. A stage that is
there and committed is read; anything else is made when it is asked for. So a flow that
was stopped goes on after its last whole stage, and a changed input or parameter makes
the stages that depend on it, and no others.

A table is written under a name of its own attempt and renamed when Spark's job has
ended, so a committed stage is whole whatever was lost; of two runs that make the same
stage, one is kept. ``finish`` removes stages that no later run should find, such as
training vectors, and what stopped attempts left behind.

Fingerprints come from the file system's listing, never from the rows. A table without
files, such as one made in memory, cannot be a source: make it in the stage, and name
its version in ``parameters``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from opinara.session import shared_dir

COMMITTED = "_stage.json"
ATTEMPT = ".attempt-"


def _digest(parts: object) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()[:32]


class _Files:
    """File systems as Spark reaches them."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def at(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.conf), path

    def exists(self, name: str) -> bool:
        files, path = self.at(name)
        return files.exists(path)

    def names(self, folder: str) -> list[str]:
        files, path = self.at(folder)
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def rename(self, old: str, new: str) -> bool:
        files, path = self.at(old)
        return files.rename(path, self.at(new)[1])

    def remove(self, name: str) -> None:
        files, path = self.at(name)
        files.delete(path, True)

    def write(self, name: str, text: str) -> None:
        files, path = self.at(name)
        out = files.create(path, True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        files, path = self.at(name)
        held = files.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        finally:
            held.close()


def input_fingerprint(df: DataFrame) -> str:
    """What the files behind a table are: path, size and time of each, and its columns."""
    files, listed = _Files(df.sparkSession), []
    for name in sorted(df.inputFiles()):
        system, path = files.at(name)
        status = system.getFileStatus(path)
        listed.append((name, status.getLen(), status.getModificationTime()))
    if not listed:
        raise ValueError("a source without files has no fingerprint; make it in the stage")
    return _digest([listed, df.schema.json()])


@dataclass
class _Stage:
    make: Callable[..., DataFrame]
    sources: tuple[str | DataFrame, ...]
    parameters: dict[str, object]
    mark: str
    passing: bool


class Flow:
    """Named stages in one folder.

    ``add`` declares a stage and ``table`` gives its rows, making it and the stages it
    reads only where no run has done so. ``made`` and ``reused`` name what this run did;
    ``counts`` holds the rows of each such stage.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.files = spark, _Files(spark)
        self.folder = (folder or f"{shared_dir(spark)}/flow-{uuid.uuid4().hex}").rstrip("/")
        self.stages: dict[str, _Stage] = {}
        self.made: list[str] = []
        self.reused: list[str] = []
        self.counts: dict[str, int] = {}

    def add(
        self,
        name: str,
        make: Callable[..., DataFrame],
        *sources: str | DataFrame,
        parameters: Mapping[str, object] | None = None,
        version: int = 1,
        passing: bool = False,
    ) -> None:
        """Declare that stage ``name`` is ``make(*tables, **parameters)``.

        A source is an earlier stage's name or a table read from files. Parameters are
        what JSON can hold. Raise ``version`` when the code of ``make`` changes what it
        returns. ``finish`` removes stages that are ``passing``.
        """
        if name in self.stages or not name.isidentifier():
            raise ValueError(f"stage {name!r} is there already or is no plain name")
        if missing := [s for s in sources if isinstance(s, str) and s not in self.stages]:
            raise ValueError(f"stage {name!r} reads {missing}, not declared before it")
        given = dict(parameters or {})
        marks = [self.stages[s].mark if isinstance(s, str) else input_fingerprint(s) for s in sources]
        self.stages[name] = _Stage(make, sources, given, _digest([name, version, given, marks]), passing)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{self.stages[name].mark}"

    def committed(self, name: str) -> bool:
        return self.files.exists(f"{self.path(name)}/{COMMITTED}")

    def table(self, name: str) -> DataFrame:
        """The stage's rows, read from its table."""
        stage = self.stages[name]
        if self.committed(name):
            if name not in self.counts:
                self.reused.append(name)
        else:
            tables = [self.table(s) if isinstance(s, str) else s for s in stage.sources]
            self._write(name, stage.make(*tables, **stage.parameters))
            self.made.append(name)
        self.counts[name] = json.loads(self.files.read(f"{self.path(name)}/{COMMITTED}"))["rows"]
        return self.spark.read.parquet(self.path(name))

    def _write(self, name: str, df: DataFrame) -> None:
        final = self.path(name)
        attempt = f"{final}{ATTEMPT}{uuid.uuid4().hex}"
        df.write.parquet(attempt)
        rows = self.spark.read.parquet(attempt).count()  # from the files' footers
        held = {"stage": name, "rows": rows, "parameters": self.stages[name].parameters}
        self.files.write(f"{attempt}/{COMMITTED}", json.dumps(held, sort_keys=True))
        if not self.files.exists(final):
            self.files.rename(attempt, final)
        if not self.committed(name):
            raise OSError(f"stage {name!r} could not be committed as {final}")
        # Another run was first: its table stays, wherever the rename has put this one.
        nested = f"{final}/{attempt.rsplit('/', 1)[1]}"
        for left in (attempt, nested):
            if self.files.exists(left):
                self.files.remove(left)

    def finish(self, superseded: bool = False) -> list[str]:
        """Remove passing stages and stopped attempts at committed ones; return their names.

        With ``superseded``, also tables of these stages made from other inputs or
        parameters. Call it when no other run of the flow is at work in the folder.
        """
        gone = []
        for folder in sorted(self.files.names(self.folder)):
            name, _, mark = folder.partition("-")
            stage = self.stages.get(name)
            if stage is None:
                continue
            own = mark == stage.mark
            stopped = ATTEMPT in mark and (superseded or self.committed(name) or stage.passing)
            if (own and stage.passing) or stopped or (superseded and not own):
                self.files.remove(f"{self.folder}/{folder}")
                gone.append(folder)
        return gone
