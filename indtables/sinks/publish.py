"""K3: publishing a refresh so that readers never meet it half done.

Every refresh writes all its tables into a release folder that no reader knows
yet, then replaces one small file, the pointer, last:

    root/_current              {"release": ..., "mode": ..., ...}
    root/releases/<release>/   silver, rejects, indicators_long, indicators_wide, ...

Readers resolve the pointer once and then read that release's folders, so they
see one refresh's silver, long and wide together: the one before a failed
refresh, never a mixture. The pointer also holds what the next refresh must know
(mode, merged pulls, row counts); it is replaced by one rename, so state and
tables change together.

Releases that the pointer no longer names expire: a full refresh keeps the one
before it, so a reader that has resolved its release has until the end of the
next refresh but one. A folder that was never published, of a refresh that died or
one that is still at work, goes a day after its last change. Incremental refreshes use two folders in turn (see
``plans.incremental``): a reader there has until the next refresh begins. One
refresh runs per root at a time; a second one is noticed before it publishes.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from indtables.session import path_exists

POINTER = "_current"
RELEASES = "releases"
PUBLISHED = "_published"
UNFINISHED_S = 24 * 3600.0


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _replace(spark: SparkSession, source, target) -> None:
    """Rename ``source`` to ``target``, replacing it."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    source, target = fs.makeQualified(source), fs.makeQualified(target)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(source, target, how)


def move_only_part(spark: SparkSession, folder: str, path: str) -> bool:
    """The one part file in ``folder`` becomes ``path``, and ``folder`` goes; False
    where it holds no part."""
    fs, source = _fs(spark, folder)
    parts = [s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")]
    if len(parts) > 1:
        raise ValueError(f"{folder} holds {len(parts)} parts")
    if parts:
        _replace(spark, parts[0], _fs(spark, path)[1])
    fs.delete(source, True)
    return bool(parts)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced by one rename: readers see the old or the new text."""
    fs, target = _fs(spark, path)
    _, temporary = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    _replace(spark, temporary, target)


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    if not path_exists(spark, path):
        return None
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Release:
    """One release of a root. ``info``: what the pointer says beside its name."""

    root: str
    name: str
    info: dict = field(default_factory=dict, compare=False)

    def path(self, table: str) -> str:
        return f"{self.root}/{RELEASES}/{self.name}/{table}"


def new_release(root: str) -> Release:
    return Release(root.rstrip("/"), f"r-{uuid.uuid4().hex}")


def pointer(spark: SparkSession, root: str) -> dict | None:
    text = read_small(spark, f"{root.rstrip('/')}/{POINTER}")
    return None if text is None else json.loads(text)


def current(spark: SparkSession, root: str) -> Release | None:
    """The published release; None before the first one."""
    found = pointer(spark, root)
    return None if found is None else Release(root.rstrip("/"), found["release"], found)


def publish(spark: SparkSession, release: Release, info: dict, replaces: dict | None) -> Release:
    """Point readers to ``release``. ``replaces`` is the pointer this refresh
    started from: another one there means that another refresh has published."""
    if pointer(spark, release.root) != replaces:
        raise RuntimeError(f"another refresh has published under {release.root}: run this one again")
    said = info | {"release": release.name}
    write_small(spark, release.path(PUBLISHED), "")
    write_small(spark, f"{release.root}/{POINTER}", json.dumps(said, sort_keys=True))
    return Release(release.root, release.name, said)


def expire(spark: SparkSession, root: str, keep: list[str], unfinished_s: float = UNFINISHED_S) -> list[str]:
    """Delete the release folders not named in ``keep``, unpublished ones only if
    nothing was added to them for ``unfinished_s``; returns their names."""
    fs, folder = _fs(spark, f"{root.rstrip('/')}/{RELEASES}")
    if not fs.exists(folder):
        return []
    before = (time.time() - unfinished_s) * 1000
    gone = []
    for s in fs.listStatus(folder):
        done = path_exists(spark, f"{s.getPath().toString()}/{PUBLISHED}")
        if s.getPath().getName() not in keep and (done or s.getModificationTime() < before):
            gone.append(s.getPath())
    for p in gone:
        fs.delete(p, True)
    return [p.getName() for p in gone]


def read_release(spark: SparkSession, release: Release, table: str, columns: list[str] | None = None) -> DataFrame:
    """A table of a release, with a clear error where its folder is gone."""
    from indtables.sources.gold import read_gold

    df = read_gold(spark, release.path(table))
    return df if columns is None else df.select(*columns)
