"""Small control files in a shared folder, through the file system Spark uses.

Records (a slice is done, a delivery is complete, a version is current) are
written whole under another name and then renamed, so a reader sees a record
or none, and of two writers of one name the second is told so.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def rename(spark: SparkSession, old: str, new: str) -> bool:
    """Give a file or folder another name; False if that name is taken."""
    fs, a = _at(spark, old)
    b = spark._jvm.org.apache.hadoop.fs.Path(new)
    if fs.exists(b):
        return False
    fs.mkdirs(b.getParent())
    return fs.rename(a, b)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def read_record(spark: SparkSession, path: str) -> dict:
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_record(spark: SparkSession, path: str, record: dict) -> bool:
    """Write a record under a name that nobody has taken; False if somebody has."""
    draft = f"{path.rpartition('/')[0]}/_draft-{uuid.uuid4().hex}"
    fs, p = _at(spark, draft)
    fs.mkdirs(p.getParent())
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(record, sort_keys=True, ensure_ascii=False).encode()))
    finally:
        out.close()
    if rename(spark, draft, path):
        return True
    fs.delete(p, False)
    return False
