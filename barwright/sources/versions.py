"""Folders that are written aside and then published in one step.

A table is a folder of numbered ones. Rows are written to a hidden folder first; publishing claims the next
number, by creating a file that nobody else could create, and renames the hidden folder to it. Readers list
numbered folders only: they find a publication whole or not at all. That holds on file systems that rename
folders in one step and create files exclusively, as HDFS and local disks do.
"""

import time
import uuid

from pyspark.sql import SparkSession

DIGITS = 10


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern, as Spark's readers take them."""
    place, files = _place(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(place) or [])


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place)


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    place, files = _place(spark, path)
    return files.createNewFile(place)


def pending(table: str) -> str:
    """A hidden folder beside the table's numbered ones."""
    return f"{table}/_pending-{uuid.uuid4().hex}"


def numbers(spark: SparkSession, table: str, name: str) -> list[str]:
    """What has been published, oldest first."""
    return [path.rsplit("=", 1)[1] for path in listed(spark, f"{table}/{name}=*")]


def _claims(spark: SparkSession, table: str) -> list[str]:
    return [path.rsplit("/", 1)[1] for path in listed(spark, f"{table}/_claims/*")]


def publish(spark: SparkSession, table: str, folder: str, name: str, number: str | None = None) -> str:
    """Make a hidden folder readable as ``name=number``, by default the next number; returns the number."""
    last = max([*_claims(spark, table), *numbers(spark, table, name)], default="0")
    following = int(last.split(".")[0]) + 1
    while number is None:
        candidate = f"{following:0{DIGITS}d}"
        if mark(spark, f"{table}/_claims/{candidate}"):
            number = candidate
        following += 1
    source, files = _place(spark, folder)
    target, _ = _place(spark, f"{table}/{name}={number}")
    if not files.rename(source, target):
        raise OSError(f"could not publish {folder} as {target}")
    return number


def unsettled(spark: SparkSession, table: str, name: str, patience_seconds: float = 3600) -> str | None:
    """The smallest number that is claimed but not published yet; claims older than that are given up."""
    published = {n.split(".")[0] for n in numbers(spark, table, name)}
    waiting = []
    for number in _claims(spark, table):
        place, files = _place(spark, f"{table}/_claims/{number}")
        age = time.time() - files.getFileStatus(place).getModificationTime() / 1000
        if number not in published and age < patience_seconds:
            waiting.append(number)
    return min(waiting, default=None)
