"""Replacement of stored folders that survives a failure at any step.

New folders are written completely into a swap folder beside the table (so a
move never crosses a file system). Then a journal is put there, in one rename,
that names every folder to replace. Each folder is moved aside, the new one
moved in, and the old ones are deleted last. A move that fails is undone with
all others, so the table keeps its old rows; where that fails too, or the
process died, the journal stays and the next job (:func:`finish_swaps`)
completes it. A swap folder without a journal was never begun and is deleted.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

MOVERS = 16  # moves at a time; each is a call to the file system
JOURNAL = "journal.json"


def file_system(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of its path objects."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = file_system(spark, path)
    return fs.exists(hadoop(path))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = file_system(spark, path)
    fs.delete(hadoop(path), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder or file to a place that is not taken."""
    fs, hadoop = file_system(spark, target)
    fs.mkdirs(hadoop(target).getParent())
    if fs.exists(hadoop(target)):  # a rename would move into it
        raise OSError(f"{target} is in the way of {source}")
    if not fs.rename(hadoop(source), hadoop(target)):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears at ``path`` whole or not at all."""
    fs, hadoop = file_system(spark, path)
    out = fs.create(hadoop(f"{path}.part"), True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(hadoop(f"{path}.part"), hadoop(path)):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = file_system(spark, path)
    stream = fs.open(hadoop(path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def new_swap(path: str) -> str:
    """A fresh swap folder of the table (or warehouse) at ``path``; new folders
    are written under its ``new``."""
    return f"{path.rstrip('/')}.swap-{uuid.uuid4().hex}"


def commit_swap(spark: SparkSession, swap: str, path: str, folders: dict[str, bool],
                mover: Callable[[SparkSession, str, str], None] | None = None) -> None:
    """Replace ``path``/folder for every folder (a relative name; ``""`` is
    ``path`` itself) by the swap folder's ``new``/folder; those with False are
    only taken away."""
    write_text(spark, f"{swap}/{JOURNAL}", json.dumps(folders, sort_keys=True))
    try:
        _complete(spark, swap, path, folders, mover or move)
    except Exception:
        _undo(spark, swap, path, folders, mover or move)
        raise


def _places(swap: str, path: str, folder: str) -> tuple[str, str, str]:
    end = f"/{folder}" if folder else ""
    return f"{path}{end}", f"{swap}/new{end}", f"{swap}/old{end}"


def _each(step: Callable[[str], None], folders) -> None:
    with ThreadPoolExecutor(MOVERS) as pool:
        for done in [pool.submit(step, f) for f in sorted(folders)]:
            done.result()


def _complete(spark, swap, path, folders, mover) -> None:
    def replace(folder: str) -> None:
        target, new, old = _places(swap, path, folder)
        if folders[folder] and not exists(spark, new):
            return  # moved in before
        if exists(spark, target):  # still the old one: the new one has not moved
            mover(spark, target, old)
        if folders[folder]:
            mover(spark, new, target)

    _each(replace, folders)
    delete(spark, f"{swap}/{JOURNAL}")
    delete(spark, swap)


def _undo(spark, swap, path, folders, mover) -> None:
    def put_back(folder: str) -> None:
        target, new, old = _places(swap, path, folder)
        if folders[folder] and not exists(spark, new) and exists(spark, target):
            mover(spark, target, new)
        if exists(spark, old):
            mover(spark, old, target)

    _each(put_back, folders)
    delete(spark, f"{swap}/{JOURNAL}")
    delete(spark, swap)


def open_swaps(spark: SparkSession, path: str) -> list[str]:
    """Swap folders that failed runs left beside ``path``."""
    fs, hadoop = file_system(spark, path)
    parent, prefix = hadoop(path).getParent(), f"{hadoop(path).getName()}.swap-"
    if not fs.exists(parent):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(parent)]
    return sorted(f"{path.rstrip('/')}{n[len(prefix) - len('.swap-'):]}" for n in names if n.startswith(prefix))


def finish_swaps(spark: SparkSession, *paths: str) -> None:
    """Complete the begun swaps of the tables at ``paths`` and delete those
    that were never begun. Jobs call it before they read."""
    for path in paths:
        path = path.rstrip("/")
        for swap in open_swaps(spark, path):
            if exists(spark, f"{swap}/{JOURNAL}"):
                _complete(spark, swap, path, json.loads(read_text(spark, f"{swap}/{JOURNAL}")), move)
            else:
                delete(spark, swap)
