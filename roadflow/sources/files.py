"""Small files and folder listings on any file system that Spark knows."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _raised(error: Py4JJavaError, *names: str) -> bool:
    return any(name in str(error.java_exception) for name in names)


def folder_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder; None if there is no such folder."""
    place, fs = _place(spark, path)
    try:
        return [f.getPath().getName() for f in fs.listStatus(place)]
    except Py4JJavaError as e:
        if _raised(e, "FileNotFoundException"):
            return None
        raise


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    place, fs = _place(spark, path)
    stream = fs.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file whole; False, without a change, if it is there already.

    The text is written under another name first and then renamed (on a local
    disk, where renaming replaces files, linked), which of several writers only
    one can do. Object stores need a connector whose rename fails on an existing
    target."""
    target, fs = _place(spark, path)
    pending, _ = _place(spark, f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(pending, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    try:
        if fs.getUri().getScheme() != "file":
            return bool(fs.rename(pending, target))
        file = spark.sparkContext._jvm.java.io.File
        spark.sparkContext._jvm.java.nio.file.Files.createLink(
            file(target.toUri().getPath()).toPath(), file(pending.toUri().getPath()).toPath())
        return True
    except Py4JJavaError as e:
        if _raised(e, "FileAlreadyExistsException"):
            return False
        raise
    finally:
        fs.delete(pending, False)


def delete_folder(spark: SparkSession, path: str) -> None:
    place, fs = _place(spark, path)
    fs.delete(place, True)
