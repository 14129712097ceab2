"""Runs: many small numbered folders kept as few merged ones.

A table that grows by a folder per batch (or epoch) ends up as many small
files. A run is a folder ``_runs/<first>-<last>-<unique>`` beside them that
holds the rows of the numbers ``first`` to ``last`` once more, in files of a
good size. It counts from the moment that an empty file of its name appears
under ``_runs/done``, which is its last step: a reader sees either the folders
or the run, and both hold the same rows. Folders that a run covers, and runs
that a wider one covers, are only removed by :func:`vacuum`, after an age that
outlasts the readers which had listed them.

A new run takes in the runs before it that span no more numbers than it does,
so there are about log2(numbers) runs, and a row is rewritten as often.
"""

from __future__ import annotations

import os
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

TARGET_BYTES = 256 * 1024 * 1024
KEEP_SECONDS = 24 * 3600


@dataclass(frozen=True)
class Run:
    first: int
    last: int
    path: str
    done_ms: int


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the store that ``path`` names."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time) of what a folder holds; none if it is missing."""
    fs, hpath = file_system(spark, path)
    if not fs.exists(hpath):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(hpath)]


def finished(spark: SparkSession, root: str) -> list[Run]:
    """Every finished run, also those that a wider one covers."""
    base = os.path.join(root, "_runs")
    out = []
    for name, at in _listed(spark, os.path.join(base, "done")):
        first, last, _ = name.split("-")
        out.append(Run(int(first), int(last), os.path.join(base, name), at))
    return out


def cover(runs: list[Run]) -> list[Run]:
    """The runs to read: one after the other from the first number on, the
    widest at each place. A gap ends them."""
    out: list[Run] = []
    start = min((r.first for r in runs), default=0)
    while True:
        fits = [r for r in runs if r.first == start]
        if not fits:
            return out
        out.append(min(fits, key=lambda r: (-r.last, r.path)))
        start = out[-1].last + 1


def current(spark: SparkSession, root: str) -> list[Run]:
    return cover(finished(spark, root))


def next_span(runs: list[Run], last: int, start: int = 0) -> tuple[int, int] | None:
    """(first, last) of the run to build so that everything up to ``last`` is
    covered; None if it is already. ``runs`` is a cover."""
    first = runs[-1].last + 1 if runs else start
    if first > last:
        return None
    for r in reversed(runs):
        if r.last - r.first > last - first:
            break
        first = r.first
    return first, last


def new_path(root: str, span: tuple[int, int]) -> str:
    return os.path.join(root, "_runs", f"{span[0]}-{span[1]}-{uuid.uuid4().hex[:12]}")


def finish(spark: SparkSession, path: str) -> None:
    """From now on readers see the run at ``path``."""
    base, name = os.path.split(path)
    fs, hpath = file_system(spark, os.path.join(base, "done", name))
    fs.create(hpath, True).close()


def files_for(spark: SparkSession, paths: list[str], target_bytes: int = TARGET_BYTES) -> int:
    """How many files of ``target_bytes`` what lies under ``paths`` makes."""
    size = 0
    for p in paths:
        fs, hpath = file_system(spark, p)
        if fs.exists(hpath):
            size += fs.getContentSummary(hpath).getLength()
    return max(1, -(-size // target_bytes))


def vacuum(spark: SparkSession, root: str, folders: list[tuple[str, str]],
           older_than: float = KEEP_SECONDS) -> int:
    """Remove what finished runs cover, ``older_than`` seconds after the run
    that covers it was finished, and unfinished runs of that age. ``folders``:
    (folder, prefix) pairs; what a folder holds is named prefix + number.
    Returns how many folders went."""
    runs = finished(spark, root)
    limit = (time.time() - older_than) * 1000
    settled = cover([r for r in runs if r.done_ms <= limit])
    covered = {r.path for r in cover(runs)} | {r.path for r in settled}
    base, gone = os.path.join(root, "_runs"), []
    for folder, prefix in folders:
        for name, _ in _listed(spark, folder):
            number = name[len(prefix):] if name.startswith(prefix) else ""
            if number.isdigit() and any(r.first <= int(number) <= r.last for r in settled):
                gone.append(os.path.join(folder, name))
    for r in runs:
        if r.path not in covered and any(s.first <= r.first and r.last <= s.last
                                         for s in settled):
            # the mark first: a run without it isn't read
            gone += [os.path.join(base, "done", os.path.basename(r.path)), r.path]
    known = {os.path.basename(r.path) for r in runs} | {"done"}
    gone += [os.path.join(base, name) for name, at in _listed(spark, base)
             if name not in known and at <= limit]
    for path in gone:
        fs, hpath = file_system(spark, path)
        fs.delete(hpath, True)
    return len(gone)
