"""Metadata-only file-system helpers over the Hadoop FileSystem API.

Works on any file system Spark can read (local, HDFS, object stores), so
the snapshot store and ledgers behave the same on a cluster.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it is missing)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob pattern (one listing call)."""
    fs, p = _fs(spark, pattern)
    found = fs.globStatus(p)
    return [] if found is None else sorted(st.getPath().toString() for st in found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a folder."""
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and all in it, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    """Write a small text file (manifests, markers); without ``overwrite`` an
    existing file is an error, so that of two writers only one goes on."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()
