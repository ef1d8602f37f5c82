"""Tables that are replaced as a whole: written to a folder of their own, then published at once.

A store is a folder with one folder per generation and a marker per published generation. Readers use the newest
published generation, so a write that fails, or is still going on, changes nothing for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from pagetrail.session import hadoop_path

KEPT = 2


def _numbers(spark: SparkSession, root: str) -> list[int]:
    folder, store = hadoop_path(spark, f"{root}/published")
    if not store.exists(folder):
        return []
    return sorted(int(status.getPath().getName()) for status in store.listStatus(folder))


def folder_of(root: str, number: int) -> str:
    return f"{root}/generations/{number:012d}"


def current(spark: SparkSession, root: str, before: int | None = None) -> str | None:
    """Folder of the newest published generation, or of the newest one numbered below ``before``; None without one."""
    numbers = [n for n in _numbers(spark, root) if before is None or n < before]
    return folder_of(root, numbers[-1]) if numbers else None


def publish(spark: SparkSession, root: str, write: Callable[[str], None], number: int | None = None, kept: int = KEPT) -> str:
    """Let ``write`` fill the folder of a new generation and publish it; the ``kept`` newest ones stay for readers.

    A generation with a given ``number`` that has been published before is left as it is. Without a number two writers at a
    time get the same one, and the second fails before it is seen.
    """
    numbers = _numbers(spark, root)
    if number in numbers:
        return folder_of(root, number)
    number = (numbers[-1] + 1 if numbers else 1) if number is None else number
    path = folder_of(root, number)
    target, store = hadoop_path(spark, path)
    store.delete(target, True)  # what a failed attempt left
    write(path)
    marker, _ = hadoop_path(spark, f"{root}/published/{number:012d}")
    store.create(marker, False).close()
    for old in [n for n in numbers if n < number][: -(kept - 1) or None]:
        store.delete(hadoop_path(spark, f"{root}/published/{old:012d}")[0], False)
        store.delete(hadoop_path(spark, folder_of(root, old))[0], True)
    return path
