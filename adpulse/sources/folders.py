"""The few folder operations that writing and reading rows does not cover, on whatever file system a path names."""

from __future__ import annotations

import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str) -> tuple[Any, Any]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _at(spark, path)
    return files.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none if it does not exist."""
    files, folder = _at(spark, path)
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def create(spark: SparkSession, path: str) -> None:
    files, folder = _at(spark, path)
    files.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    files, folder = _at(spark, path)
    files.delete(folder, True)


def modified(spark: SparkSession, path: str) -> float:
    """Seconds since the epoch at which anything directly in ``path`` changed last."""
    files, folder = _at(spark, path)
    times = [status.getModificationTime() for status in files.listStatus(folder)]
    return max([files.getFileStatus(folder).getModificationTime(), *times]) / 1000


def read_text(spark: SparkSession, path: str) -> str:
    files, file = _at(spark, path)
    source = files.open(file)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Makes a file with this text, which others see whole or not at all; False if there is one already. Renaming onto a
    file is refused by HDFS, and a local file system refuses a second link; object stores that can do neither need a
    single writer."""
    files, file = _at(spark, path)
    jvm = spark.sparkContext._jvm
    files.mkdirs(file.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(file.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    try:
        if files.getUri().getScheme() != "file":
            return bool(files.rename(draft, file))
        link, target = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (file, draft))
        try:
            jvm.java.nio.file.Files.createLink(link, target)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in str(error.java_exception):
                return False
            raise
        return True
    finally:
        files.delete(draft, False)
