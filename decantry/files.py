"""Small files and folders beside the tables, by the file system that Spark itself uses.

Whether a folder exists, what it holds and a few lines of text are questions to the store,
not to the engine: as Spark jobs each would cost more than a small table's scan. Spark has
no public call for them, so this module alone goes through its Hadoop client.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system has ``path``; nothing is listed or read."""
    store, location = _at(spark, path)
    return store.exists(location)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder, in order; none where there is no folder."""
    store, location = _at(spark, folder)
    if not store.exists(location):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(location))


def read_text(spark: SparkSession, path: str) -> str:
    store, location = _at(spark, path)
    stream = store.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file under a name of its own, which nobody sees before it is complete."""
    store, location = _at(spark, path)
    draft = _at(spark, f"{path}.tmp")[1]
    _fill(store.create(draft, True), text)
    if not store.rename(draft, location):
        raise OSError(f"cannot rename {path}.tmp")


def claim(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that only one writer can: for all others it exists already.

    Readers may see it before its text is there, and a writer that dies leaves it so.
    """
    store, location = _at(spark, path)
    try:
        out = store.create(location, False)
    except Py4JJavaError as e:
        if store.exists(location):
            raise FileExistsError(path) from e
        raise
    _fill(out, text)


def _fill(out, text: str) -> None:
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is in it, if it exists."""
    store, location = _at(spark, path)
    store.delete(location, True)


def bytes_below(spark: SparkSession, folder: str) -> int:
    """Size of all files in a folder, from their listing."""
    store, location = _at(spark, folder)
    return store.getContentSummary(location).getLength() if store.exists(location) else 0
