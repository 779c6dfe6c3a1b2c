"""Small file operations in whatever store the tables are in (Hadoop's FileSystem, as Spark's readers use).

Only names, sizes and texts of a few kilobytes pass through the driver, never tables.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    modified_ms: int


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies directly in a folder; nothing if there is no such folder."""
    fs, p = _at(spark, folder)
    if not fs.exists(p):
        return []
    return [Entry(s.getPath().getName(), s.getPath().toString(), s.getModificationTime()) for s in fs.listStatus(p)]


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file; False if there is one of that name already."""
    fs, p = _at(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as err:
        if fs.exists(p):
            return False
        raise err
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    size = fs.getFileStatus(p).getLen()
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(int(size))).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def last_json(spark: SparkSession, folder: str, writing_seconds: float) -> tuple[dict | None, int]:
    """Of files named <number>.json the content of the last that is whole, and the highest number. A file that
    is not whole is waited for as long as it may still be being written."""
    while True:
        found = sorted((e for e in entries(spark, folder) if e.name.endswith(".json")), key=lambda e: e.name, reverse=True)
        for e in found:
            try:
                return json.loads(read_text(spark, e.path)), int(found[0].name[:-5])
            except ValueError:
                if time.time() - e.modified_ms / 1000 < writing_seconds:
                    break
        else:
            return None, int(found[0].name[:-5]) if found else 0
        time.sleep(0.2)
