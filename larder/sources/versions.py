"""Tables that change all at once.

Rows lie in run folders, ``run=<name>/<partition>/``, which are written once and never
changed. Which of them are the table is said by one small file per version,
``_versions/<number>.json``. A writer adds runs, which nobody sees, and then one
version file; a reader takes the version with the largest number. So a whole table, or
any set of its partitions, is replaced in one step, on file systems with and without a
rename of folders, and whatever fails in between leaves the version before.

A version's file is made under its final name only when it is whole, and never twice:
of two writers that start from one version the second gets ``Superseded``. The files of
the version before stay until the next one is published, for readers that have begun.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from larder.sources.storage import children, delete, exists, file_system

FOLDER = "_versions"
KEPT = 2


class Superseded(Exception):
    """Another writer has published the version that this one was to be."""


@dataclass(frozen=True)
class Version:
    """Which runs hold the rows of each partition; the partition of a table without any is ``""``."""

    number: int
    parts: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    notes: Mapping[str, int] = field(default_factory=dict)

    def following(self, parts: Mapping[str, Iterable[str]], **notes: int) -> Version:
        return Version(self.number + 1, {p: tuple(r) for p, r in parts.items() if r}, {**self.notes, **notes})

    def folders(self) -> set[tuple[str, str]]:
        return {(run, part) for part, of_part in self.parts.items() for run in of_part}


NONE = Version(0)


def new_run(level: int = 0) -> str:
    return f"{level}-{uuid.uuid4().hex}"


def run_folder(path: str, run: str) -> str:
    return f"{path.rstrip('/')}/run={run}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, folder = file_system(spark, f"{path.rstrip('/')}/{FOLDER}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())


def _file(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{FOLDER}/{number:012d}.json"


def _load(spark: SparkSession, path: str, number: int) -> Version:
    fs, file = file_system(spark, _file(path, number))
    stream = fs.open(file)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    body = json.loads(text)
    return Version(number, {p: tuple(r) for p, r in body["parts"].items()}, body["notes"])


def current(spark: SparkSession, path: str) -> Version:
    """The version that readers see; number 0 if nothing was published."""
    numbers = _numbers(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else NONE


def publish(spark: SparkSession, path: str, version: Version, kept: int = KEPT) -> None:
    """Make ``version`` the current one, in one step, and drop what only older ones than ``kept`` hold."""
    body = json.dumps({"parts": {p: list(r) for p, r in version.parts.items()}, "notes": dict(version.notes)})
    draft = f"{path.rstrip('/')}/{FOLDER}/.{uuid.uuid4().hex}"
    fs, temporary = file_system(spark, draft)
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()
    _, target = file_system(spark, _file(path, version.number))
    # A rename onto a file that is there fails, so no version is published twice.
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise Superseded(f"{path}: version {version.number} is there already")
    clean(spark, path, kept)


def clean(spark: SparkSession, path: str, kept: int = KEPT) -> None:
    """Delete all but the last ``kept`` versions, and the folders that only the deleted ones name."""
    numbers = _numbers(spark, path)
    if len(numbers) <= kept:
        return
    live = set()
    for number in numbers[-kept:]:
        live |= _load(spark, path, number).folders()
    for number in numbers[:-kept]:
        for run, part in sorted(_load(spark, path, number).folders() - live):
            delete(spark, f"{run_folder(path, run)}/{part}".rstrip("/"))
            if part and not children(spark, run_folder(path, run), missing=True):
                delete(spark, run_folder(path, run))
        delete(spark, _file(path, number))


def partitions_of(spark: SparkSession, path: str, run: str, depth: int) -> list[str]:
    """The partition folders of a run; ``[""]`` for a run that is not partitioned."""
    found = [""]
    for _ in range(depth):
        found = [
            f"{b}/{c}".lstrip("/") for b in found for c in children(spark, f"{run_folder(path, run)}/{b}") if "=" in c
        ]
    return found


def replace(spark: SparkSession, path: str, run: str, depth: int, only_touched: bool = False) -> Version:
    """Publish a finished run as the whole table, or in place of the partitions that it has."""
    before = current(spark, path)
    if only_touched and not before.number:
        others = [c for c in children(spark, path) if c != f"run={run}"]
        if others:
            raise ValueError(f"{path} holds a table without versions; write it whole once")
    parts = {p: (run,) for p in partitions_of(spark, path, run, depth)}
    version = before.following({**before.parts, **parts} if only_touched else parts)
    publish(spark, path, version)
    return version


def live_folders(path: str, version: Version, parts: Iterable[str] | None = None) -> list[str]:
    chosen = version.parts if parts is None else [p for p in parts if p in version.parts]
    return [f"{run_folder(path, run)}/{p}".rstrip("/") for p in chosen for run in version.parts[p]]


def read(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    parts: Iterable[str] | None = None,
    version: Version | None = None,
) -> DataFrame:
    """The rows of a version, or of some of its partitions. Without ``schema`` the files tell it."""
    version = version or current(spark, path)
    folders = live_folders(path, version, parts)
    if not folders:
        return spark.createDataFrame([], schema or StructType())
    reader = spark.read.option("basePath", path)
    if schema is not None:
        return reader.schema(schema).parquet(*folders).select(*[f"`{f.name}`" for f in schema.fields])
    return reader.parquet(*folders).drop("run")


def is_versioned(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{FOLDER}")


@contextmanager
def run_of(spark: SparkSession, path: str, level: int = 0) -> Iterator[str]:
    """The name of a new run, to be written and published inside; gone if it is not published."""
    run = new_run(level)
    try:
        yield run
    finally:
        drop_run(spark, path, run)


def drop_run(spark: SparkSession, path: str, run: str) -> None:
    """Delete a run that was not published; one that a version names stays."""
    if any(run == r for r, _ in current(spark, path).folders()):
        return
    try:
        delete(spark, run_folder(path, run))
    except Py4JJavaError:  # what cannot be deleted now is seen by nobody
        pass
