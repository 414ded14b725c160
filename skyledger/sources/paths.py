"""Folders and files, on whatever file system the cluster uses."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _hadoop(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _hadoop(spark, path)
    fs.delete(hadoop_path, True)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    fs, hadoop_path = _hadoop(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(hadoop_path)] if fs.exists(hadoop_path) else []


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as a catalog needs it."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small ASCII file, written over one that is there."""
    fs, hadoop_path = _hadoop(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.writeBytes(text)
    finally:
        out.close()


def read_line(spark: SparkSession, path: str) -> str:
    """The first line of a small ASCII file."""
    fs, hadoop_path = _hadoop(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return stream.readLine() or ""
    finally:
        stream.close()


def modified(spark: SparkSession, path: str) -> int:
    """When a file was last changed, in milliseconds of the file system's clock."""
    fs, hadoop_path = _hadoop(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def last_change(spark: SparkSession, folder: str) -> int | None:
    """When the newest file below a folder was changed; None if there is no file."""
    fs, hadoop_path = _hadoop(spark, folder)
    found, newest = fs.listFiles(hadoop_path, True), None
    while found.hasNext():
        newest = max(newest or 0, found.next().getModificationTime())
    return newest


def _link(spark: SparkSession, whole, target) -> bool:
    """On a mounted file system: a second name, which fails if the name is taken."""
    try:
        os.link(whole.toUri().getPath(), target.toUri().getPath())
    except FileExistsError:
        return False
    return True


def _rename(spark: SparkSession, whole, target) -> bool:
    """On HDFS and its like: a rename that does not overwrite."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(whole, target, options)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that is there whole or not at all. False, and nothing done, if one has the name already.

    Of any number of writers of a name one succeeds: by a hard link on mounted file systems, by a
    rename without overwriting elsewhere, which HDFS does at once. An object store whose
    rename is a copy does not keep two writers apart who come at the same moment.
    """
    fs, target = _hadoop(spark, path)
    target = fs.makeQualified(target)
    part = f"{target.getParent()}/.{target.getName()}-{uuid.uuid4().hex}"
    write_text(spark, part, text)
    _, whole = _hadoop(spark, part)
    try:
        return (_link if fs.getUri().getScheme() == "file" else _rename)(spark, whole, target)
    finally:
        delete(spark, part)


def first_existing(spark: SparkSession, folder: str, names: tuple[str, ...]) -> str:
    for name in names:
        path = f"{folder.rstrip('/')}/{name}"
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"None of {list(names)} in {folder}")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for intermediate data in ``spark.checkpoint.dir``.

    Without the setting a session in local mode gets a temporary folder of its own;
    on a cluster a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="skyledger-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Staging:
    """Cuts lineage by writing an intermediate result once as parquet.

    What is staged goes with ``close``, else when the process ends in good order: a frame
    handed out may be read at any time before.
    """

    _open: dict[str, SparkSession] = {}

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/staging-{uuid.uuid4().hex}"
        Staging._open[self.folder] = spark

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *names: str) -> None:
        """Gives the room of results back that nothing will read any more."""
        for name in names:
            delete(self.spark, f"{self.folder}/{name}")

    def close(self) -> None:
        Staging._open.pop(self.folder, None)
        delete(self.spark, self.folder)


@atexit.register
def _remove_staged() -> None:
    for folder, spark in Staging._open.items():
        with suppress(Exception):  # the session may be gone
            delete(spark, folder)
