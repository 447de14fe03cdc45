"""Tables that are replaced at once: versioned folders, and a manifest that is committed last.

A table's folder holds ``_versions/<id>`` with the files of each version and ``_manifest/<number>.json``, one small file a
commit. A version is written under a name of its own; only when it is complete is the next manifest file created, under its
final name or not at all. Readers take the highest manifest, so they see the old version or the new one and never a part of
either, and a task or driver that dies leaves the old version in place. Two writers that commit the same number cannot
both succeed: the second one raises :class:`Conflict`.

``forget`` removes versions that no kept manifest names, unfinished ones of failed runs included. Names begin with an
underscore, so a plain read of the folder finds no files in it instead of several versions.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from patronlens.sources.buckets import default_buckets, read_bucketed, write_bucketed
from patronlens.sources.staging import remove

VERSIONS, MANIFEST = "_versions", "_manifest"
KEPT = 2


class Conflict(RuntimeError):
    """Another writer has committed meanwhile."""


@dataclass(frozen=True)
class Commit:
    """One committed version: its number, folder, run, the versions it was made from, and how its rows lie, if by a key."""

    number: int
    folder: str
    run_id: str = ""
    inputs: tuple[str, ...] = ()
    key: str = ""
    buckets: int = 0


def _path(name: str):
    return SparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _system(spark: SparkSession, name: str):
    return _path(name).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    system = _system(spark, folder)
    if not system.exists(_path(folder)):
        return []
    return sorted(f.getPath().getName() for f in system.listStatus(_path(folder)))


def _write_once(spark: SparkSession, name: str, content: str) -> None:
    """A file that appears whole under its name, which must be new."""
    system, draft = _system(spark, name), f"{name}.{uuid.uuid4().hex}.draft"
    out = system.create(_path(draft), False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    if system.exists(_path(name)) or not system.rename(_path(draft), _path(name)):
        system.delete(_path(draft), False)
        raise Conflict(f"{name} has been committed by another writer")


def _read_text(spark: SparkSession, name: str) -> str:
    return "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(name).collect())


def commits(spark: SparkSession, table: str) -> list[Commit]:
    """All commits of a table that are still on record, the latest last."""
    folder = f"{table}/{MANIFEST}"
    found = []
    for name in _names(spark, folder):
        if name.endswith(".json"):
            told = json.loads(_read_text(spark, f"{folder}/{name}"))
            found.append(Commit(**told | {"inputs": tuple(told["inputs"])}))
    return sorted(found, key=lambda c: c.number)


def current(spark: SparkSession, table: str) -> Commit | None:
    """The latest commit, None if there is none."""
    numbers = [n for n in _names(spark, f"{table}/{MANIFEST}") if n.endswith(".json")]
    if not numbers:
        return None
    told = json.loads(_read_text(spark, f"{table}/{MANIFEST}/{numbers[-1]}"))
    return Commit(**told | {"inputs": tuple(told["inputs"])})


def read(spark: SparkSession, table: str, number: int | None = None) -> DataFrame:
    """The latest version of a table, or an earlier one that is still kept."""
    found = current(spark, table) if number is None else next((c for c in commits(spark, table) if c.number == number), None)
    if found is None:
        raise FileNotFoundError(f"{table} has no committed version" + (f" {number}" if number is not None else ""))
    folder = f"{table}/{VERSIONS}/{found.folder}"
    if found.buckets:
        return read_bucketed(spark, folder, found.key, found.buckets)
    return spark.read.parquet(folder)


def publish(
    df: DataFrame, table: str, run_id: str = "", inputs: tuple[str, ...] = (), keep: int = KEPT, key: str = "", buckets: int = 0
) -> Commit:
    """Write ``df`` as the next version of ``table`` and commit it; ``df`` may read the table itself.

    With ``key``, which should differ from row to row, the version lies in buckets of it (as many as the session has
    shuffle partitions unless told), and readers join it on the key without moving it.
    """
    spark = df.sparkSession
    before = current(spark, table)
    number, buckets = before.number + 1 if before else 1, (buckets or default_buckets(spark)) if key else 0
    commit = Commit(number, uuid.uuid4().hex, run_id, tuple(inputs), key, buckets)
    folder = f"{table}/{VERSIONS}/{commit.folder}"
    if key:
        write_bucketed(df, folder, key, buckets)
    else:
        df.write.parquet(folder)
    _system(spark, table).mkdirs(_path(f"{table}/{MANIFEST}"))
    _write_once(spark, f"{table}/{MANIFEST}/{commit.number:012d}.json", json.dumps(asdict(commit)))
    forget(spark, table, keep, commit)
    return commit


def forget(spark: SparkSession, table: str, keep: int = KEPT, own: Commit | None = None) -> list[str]:
    """Remove all but the last ``keep`` versions, and those that were never committed before ``own`` was.

    A version that another writer is writing right now is not committed either, but newer than the last commit; only
    folders older than it go. Returns what was removed.
    """
    kept = commits(spark, table)
    gone = kept[:-keep] if keep else kept
    for c in gone:
        remove(f"{table}/{MANIFEST}/{c.number:012d}.json")
    system, named = _system(spark, table), {c.folder for c in kept[len(gone) :]}
    latest = max((c.number for c in kept), default=0)
    stamp = f"{table}/{MANIFEST}/{latest:012d}.json"
    until = system.getFileStatus(_path(stamp)).getModificationTime() if latest else 0
    removed = []
    for name in _names(spark, f"{table}/{VERSIONS}"):
        folder = f"{table}/{VERSIONS}/{name}"
        committed = any(c.folder == name for c in gone)
        if name not in named and (committed or system.getFileStatus(_path(folder)).getModificationTime() < until - UNFINISHED_MS):
            remove(folder)
            removed.append(name)
    return removed


# Folders without a commit are taken for those of failed writers once they are so much older than the latest commit.
UNFINISHED_MS = 24 * 3600 * 1000
