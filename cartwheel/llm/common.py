"""Shared helpers of the operators: tables, row keys, written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for written intermediate tables: ``spark.checkpoint.dir`` of
    the session. Only a local session without it gets a scratch folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwheel-llm-"))
    return spark.sparkContext.getCheckpointDir()


_scratch: list[list[str]] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    folder = os.path.join(shared_dir(spark), "cartwheel-llm", uuid.uuid4().hex)
    for folders in _scratch:
        folders.append(folder)
    return os.path.join(folder, name)


@contextmanager
def noted() -> Iterator[list[str]]:
    """Lists the folders that are written inside the block, for ``release``."""
    _scratch.append([])
    try:
        yield _scratch[-1]
    finally:
        _scratch.pop()


def release(spark: SparkSession, folders: list[str], *needed: DataFrame | None) -> list[str]:
    """Delete the folders that hold no input file of any frame ``needed``; returns those left."""
    files = [f for df in needed if df is not None for f in df.inputFiles()]
    left = []
    for folder in folders:
        if any(f"/{os.path.basename(folder)}/" in f for f in files):
            left.append(folder)
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return left


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: this cuts the
    lineage, survives lost executors, and lets the planner see its true size.
    The shuffle files behind it are not needed any more and go at once."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``did, rk, text, id``: a row is known by its id and a hash of id and text, so
    null and repeated ids need no special case. Rows equal in both are one row
    to the operators, and each of them gets the same result."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("did"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("rk"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).cast("long").alias("id"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def key_names(docs: DataFrame) -> tuple[str, str]:
    """The names of the row key that ``with_key`` adds to ``docs``."""
    return free_name(docs, "__did"), free_name(docs, "__rk")


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` beside its row key, named by ``key_names``."""
    did, rk = key_names(docs)
    return docs.withColumns({
        did: F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
        rk: F.xxhash64(F.col(id_col), F.col(text_col))})


def attach(docs: DataFrame, info: DataFrame, how: str = "left",
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of ``info`` (one row for each ``did, rk``) put into one
    struct column, named ``free_name(docs, "__info")``, so no column of ``docs`` is lost."""
    did, rk = key_names(docs)
    packed = info.select(F.col("did").alias(did), F.col("rk").alias(rk), F.struct(
        *[c for c in info.columns if c not in ("did", "rk")]).alias(free_name(docs, "__info")))
    return with_key(docs, id_col, text_col).join(packed, [did, rk], how).drop(did, rk)
