"""Small driver-side files on any store that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return fs.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, or None where there is no file."""
    fs, target = _at(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside the file and move it into place, so that readers see the old text or the new."""
    fs, target = _at(spark, path)
    _, beside = _at(spark, f"{path}.new")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(beside, target):  # stores whose rename does not replace
        fs.delete(target, False)
        if not fs.rename(beside, target):
            raise OSError(f"could not put {path} in place")


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what is in a folder; none where there is no folder."""
    fs, target = _at(spark, folder)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was last changed, in seconds since 1970."""
    fs, target = _at(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not be there yet; False, with the file as it was, if it is."""
    fs, target = _at(spark, path)
    if fs.exists(target):
        return False
    try:
        out = fs.create(target, False)  # stores that can, refuse this if another has come first
    except Exception:
        if fs.exists(target):
            return False
        raise
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return True
