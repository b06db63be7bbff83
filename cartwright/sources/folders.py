"""Small files next to the data, on whatever file system holds the data."""

from __future__ import annotations

import codecs
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def remove_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def text_lines(spark: SparkSession, path: str, block_bytes: int = 1 << 20) -> Iterator[str]:
    """The lines of a UTF-8 file, read block by block."""
    stream = _file_system(spark, path).open(_path(spark, path))
    decoder, rest = codecs.getincrementaldecoder("utf-8")(), ""
    try:
        while block := bytes(stream.readNBytes(block_bytes)):
            *lines, rest = (rest + decoder.decode(block)).split("\n")
            yield from lines
        if rest:
            yield rest
    finally:
        stream.close()


@dataclass(frozen=True)
class Entry:
    """What the file system says of a path, links not followed."""

    name: str
    size: int
    is_link: bool
    is_folder: bool
    modified: int


def _entry(spark: SparkSession, fs, path) -> Entry:
    # Without its scheme: the local file system looks for links by the plain path only.
    status = fs.getFileLinkStatus(_path(spark, path.toUri().getPath()))
    return Entry(path.getName(), status.getLen(), status.isSymlink(), status.isDirectory(), status.getModificationTime())


def entry(spark: SparkSession, path: str) -> Entry | None:
    try:
        return _entry(spark, _file_system(spark, path), _path(spark, path))
    except Py4JJavaError as exc:
        if "FileNotFoundException" in exc.java_exception.getClass().getName():
            return None
        raise


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What lies in a folder, each looked at as a possible link."""
    fs = _file_system(spark, path)
    return [_entry(spark, fs, status.getPath()) for status in fs.listStatus(_path(spark, path))]


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False if it is.

    Of several writers one wins, as far as the file system renames without overwriting in one step, as HDFS does.
    """
    try:
        _put_text(spark, path, text, overwrite=False)
    except Py4JJavaError as exc:
        if "FileAlreadyExistsException" in exc.java_exception.getClass().getName():
            return False
        raise
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the target, then take its place in one rename."""
    _put_text(spark, path, text, overwrite=True)


def _put_text(spark: SparkSession, path: str, text: str, overwrite: bool) -> None:
    staged = f"{path}.{uuid.uuid4().hex}.tmp"
    fs = _file_system(spark, staged)
    stream = fs.create(_path(spark, staged), True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options[0] = rename.OVERWRITE if overwrite else rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, path).toUri() if ":" in path else fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, staged), _path(spark, path), options)
    except Exception:
        fs.delete(_path(spark, staged), False)
        raise
