"""Parquet tables that are replaced whole, or by partition, in one step.

A write goes to a new folder ``snapshot=<n>`` of the table, and counts once a commit names it.
Commits are one chain of small files, ``_commits/<k>``: each has, for every partition, the
version that holds it, so a reader opens one file however many there are, and a failed write
leaves readers the state before it. An empty partition is there as such.

A commit names the partitions it replaces. It is refused if one of them was replaced
by someone else since the version it was computed from (``base``). The file of a commit
appears with its content or not at all, and only where there is none: of two writers that
want the same place in the chain one gets it, and the other reads the state again, checks
again and takes the next. Running readers are not disturbed; ``expire`` removes old versions
that nothing refers to any more.
"""

from __future__ import annotations

import json
import os
import re
import time
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMITS = "_commits"
_VERSION = re.compile(r"^snapshot=(\d+)$")
_PLAIN = re.compile(r"^[\w.\- ]+$")


class StaleTable(RuntimeError):
    """What a write was computed from has been replaced meanwhile."""


class Part(NamedTuple):
    """One partition: the version with its files, whether it has any, the commit, a mark."""

    version: int
    filled: bool
    commit: int
    mark: object = None


class State(NamedTuple):
    """A table as one commit left it."""

    commit: int
    parts: dict[str, Part]


class _Folder:
    """The few file system calls needed, on whatever system the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        p = self._path(path)
        if not self._fs.exists(p):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(p)]

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def write(self, path: str, text: str) -> None:
        out = self._fs.create(self._path(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def put_new(self, path: str, text: str) -> bool:
        """Make a file with its content in one step; False if there is one already.

        A link of a local file, elsewhere a rename: both fail where a file is (an object
        store may not tell, see above).
        """
        draft = f"{path}.{os.urandom(6).hex()}.draft"
        self.write(draft, text)
        try:
            if self._fs.getScheme() == "file":
                local = [
                    self._jvm.java.nio.file.Paths.get(self._fs.makeQualified(self._path(p)).toUri())
                    for p in (path, draft)
                ]
                self._jvm.java.nio.file.Files.createLink(*local)
                return True
            return self._fs.rename(self._path(draft), self._path(path))
        except Py4JJavaError as error:
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        finally:
            self._fs.delete(self._path(draft), False)

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def age(self, path: str) -> float:
        return time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _versions(folder: _Folder, root: str) -> list[int]:
    """All versions, newest first, committed or not."""
    found = [_VERSION.match(n) for n in folder.names(root)]
    return sorted((int(m.group(1)) for m in found if m), reverse=True)


def _claim(folder: _Folder, root: str) -> int:
    """A version of our own: its claim file can be created by one writer only."""
    n = max(_versions(folder, root), default=0) + 1
    while not folder.put_new(f"{root}/snapshot={n}/_CLAIMED", ""):
        n += 1
    return n


def _part_name(by: str, value: object) -> str:
    text = str(value)
    if value is None or not _PLAIN.match(text):
        raise ValueError(f"cannot use {value!r} as a partition of {by}")
    return f"{by}={text}"


def _commits(folder: _Folder, root: str) -> list[int]:
    """The numbers of all commits, newest first."""
    return sorted((int(n) for n in folder.names(f"{root}/{COMMITS}") if n.isdigit()), reverse=True)


def _parts(folder: _Folder, root: str, commit: int) -> dict[str, Part]:
    return {name: Part(*p) for name, p in json.loads(folder.read(f"{root}/{COMMITS}/{commit}")).items()}


def _state(folder: _Folder, root: str) -> State:
    newest = next(iter(_commits(folder, root)), 0)
    return State(newest, _parts(folder, root, newest) if newest else {})


def state(spark: SparkSession, root: str) -> State:
    """The newest commit and what it holds; give its number to :func:`publish` as ``base``."""
    return _state(_Folder(spark, root), root)


def partitions(spark: SparkSession, root: str, by: str) -> dict[str, str]:
    """Folder name of each partition -> path of its newest committed version."""
    parts = state(spark, root).parts
    return {n: f"{root}/snapshot={p.version}/{n}" for n, p in parts.items() if n.startswith(by + "=")}


def current(
    spark: SparkSession,
    root: str,
    by: str | None = None,
    values: Iterable[object] | None = None,
    schema: StructType | None = None,
    at: State | None = None,
) -> DataFrame | None:
    """The table as last committed, or None. ``values`` reads only these partitions.

    ``at`` reads it as it was in a state taken before.
    """
    at = at or state(spark, root)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if by is None:
        whole = at.parts.get("")
        return reader.parquet(f"{root}/snapshot={whole.version}") if whole else None
    parts = at.parts
    if values is not None:
        wanted = {_part_name(by, v) for v in values}
        parts = {n: p for n, p in parts.items() if n in wanted}
    filled = [f"{root}/snapshot={p.version}/{n}" for n, p in parts.items() if p.filled]
    if filled:
        return reader.option("basePath", root).parquet(*filled).drop("snapshot")
    return None if schema is None else spark.createDataFrame([], schema)


def _has_files(folder: _Folder, path: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in folder.names(path))


def publish(
    df: DataFrame,
    root: str,
    by: str | None = None,
    replaced: Iterable[object] | None = None,
    base: int | None = None,
    marks: Mapping[object, object] | None = None,
) -> str:
    """Write a new version and commit it.

    Without ``by`` the whole table is replaced. With it, exactly the partitions
    in ``replaced`` are, and ``df`` may hold no row of another: that is checked
    before the commit. ``replaced`` may be left out only for a new table. ``base`` is
    the commit that ``df`` was computed from: if a replaced partition has a newer one,
    nothing is committed. ``marks`` keeps a value with a replaced partition.
    """
    spark = df.sparkSession
    folder = _Folder(spark, root)
    if by and replaced is None and partitions(spark, root, by):
        raise ValueError("name the partitions to replace")
    names = None if replaced is None else {_part_name(by, v) for v in replaced}
    n = _claim(folder, root)
    target = f"{root}/snapshot={n}"
    for name in names or ():
        folder.mkdirs(f"{target}/{name}")
    if by and (names is None or len(names) > 1):
        # Rebalancing by the column that decides the folder keeps files large:
        # it splits a month too big for one task and joins those that are small.
        df = df.hint("rebalance", by)
    writer = df.write.mode("append").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    )
    (writer.partitionBy(by) if by else writer).parquet(target)
    own = {""} if by is None else {x for x in folder.names(target) if x.startswith(by + "=")}
    if names is not None and own != names:
        raise ValueError(f"rows of partitions not replaced: {sorted(own - names)}")
    kept = {_part_name(by, v): m for v, m in (marks or {}).items()}
    _commit(folder, root, n, own, base, kept)
    return target


def _commit(
    folder: _Folder, root: str, n: int, own: set[str], base: int | None, marks: Mapping[str, object]
) -> None:
    """Make version ``n`` count for the partitions ``own``, on top of what is committed by now."""
    filled = {x: x == "" or _has_files(folder, f"{root}/snapshot={n}/{x}") for x in own}
    while True:
        before = _state(folder, root)
        newer = sorted(x for x in own if x in before.parts and before.parts[x].commit > (base or 0))
        if base is not None and newer:
            raise StaleTable(f"replaced since commit {base}: {', '.join(newer) or root}")
        commit = before.commit + 1
        parts = before.parts | {x: Part(n, filled[x], commit, marks.get(x)) for x in own}
        if folder.put_new(f"{root}/{COMMITS}/{commit}", json.dumps(parts)):
            return


def expire(spark: SparkSession, root: str, keep: int = 10, older_than: float = 0.0) -> list[str]:
    """Delete versions that none of the newest ``keep`` commits refers to; returns the paths.

    Only folders whose claim is older than ``older_than`` seconds are looked at, which
    must be longer than the longest write or read. The version that holds a partition now is
    never deleted, however old; other partitions in its folder are.
    """
    folder = _Folder(spark, root)
    commits = _commits(folder, root)
    held = {n: _parts(folder, root, n) for n in commits[: max(keep, 1)]}
    used = {(p.version, name) for parts in held.values() for name, p in parts.items()}
    newest = max((v for v, _ in used), default=0)
    gone = []
    for n in _versions(folder, root):
        path = f"{root}/snapshot={n}"
        if n > newest or folder.age(f"{path}/_CLAIMED") < older_than:
            continue
        mine = {name for v, name in used if v == n}
        if not mine:
            gone.append(path)
        elif "" not in mine:
            gone += [f"{path}/{x}" for x in folder.names(path) if "=" in x and x not in mine]
    for path in gone:
        folder.delete(path)
    for n in commits[max(keep, 1) :]:
        if gone or older_than == 0:
            folder.delete(f"{root}/{COMMITS}/{n}")
    return gone
