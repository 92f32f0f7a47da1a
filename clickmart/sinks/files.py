"""Small file-system steps on the driver, on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists (local, HDFS, object store)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    fs, p = _fs(spark, pattern)
    return [str(s.getPath().toString()) for s in fs.globStatus(p) or ()]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a file or folder to a name that is not taken."""
    fs, p = _fs(spark, old)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"could not move {old} to {new}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` in the place of what is there, if anything is."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def stamp(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of the file at ``path``, or of the files right in it."""
    fs, p = _fs(spark, path)
    status = fs.listStatus(p) if fs.exists(p) else ()
    return tuple(sorted((str(s.getPath().getName()), int(s.getLen()), int(s.getModificationTime())) for s in status))


def write_once(spark: SparkSession, path: str, text: str) -> str:
    """Write ``text`` unless ``path`` is there already; what it says then."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        out = fs.create(p, False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
    return read_text(spark, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
