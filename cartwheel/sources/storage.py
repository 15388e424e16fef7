"""The few file-system steps that tables and landings need, on any Hadoop file system.

Data are read and written by Spark; these functions only list, make, rename and delete
names, and read and write the small manifests.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


LISTED = "path string, modified bigint, bytes bigint"


class Taken(RuntimeError):
    """Somebody else has written the name first."""


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()


def _fs(spark: SparkSession, path: str):
    jvm, conf = _jvm(spark)
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """``(name, bytes)`` of what lies directly in a folder, by name; none if there is no such folder."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted((s.getPath().getName(), int(s.getLen())) for s in fs.listStatus(p))


def rename_new(spark: SparkSession, source: str, target: str) -> None:
    """Rename one file or folder; ``Taken`` if the target is there already. On file
    systems with atomic rename exactly one of several writers succeeds."""
    jvm, conf = _jvm(spark)
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = dst.getFileSystem(conf)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(src), fs.makeQualified(dst), none)
    except Exception as error:
        if fs.exists(dst) and fs.exists(src):
            raise Taken(target) from error
        raise


def write_new(spark: SparkSession, path: str, content: dict) -> None:
    """Write a small JSON file under a name of its own, then give it its name if that is free."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    fs, p = _fs(spark, draft)
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    try:
        rename_new(spark, draft, path)
    except Taken:
        delete(spark, draft)
        raise


def read_json(spark: SparkSession, path: str) -> dict:
    jvm, _ = _jvm(spark)
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def plain(path: str) -> str:
    """A path whose pattern characters stand for themselves."""
    return "".join("\\" + c if c in "\\[]{}*?" else c for c in path)


def listing(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``path, modified`` (microseconds) and ``bytes`` of the files of a folder; nothing of them is read."""
    if not exists(spark, folder):
        return spark.createDataFrame([], LISTED)
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(plain(folder))
            .select("path", F.unix_micros("modificationTime").alias("modified"), F.col("length").alias("bytes")))
