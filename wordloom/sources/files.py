"""Byte streams of files by the path Spark reports for them."""

from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark reports it; one without a scheme is on the default file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(found).toString()


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow file system and name behind a path as Spark writes it ('file:/a', 's3a://b/c', 'hdfs://…')."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), unquote("/" + rest.lstrip("/"))
    return fs.FileSystem.from_uri(("s3" if scheme in ("s3a", "s3n") else scheme) + ":" + rest)


def open_gzip(path: str) -> pa.NativeFile:
    filesystem, name = locate(path)
    return filesystem.open_input_stream(name, compression="gzip")


def open_seekable(path: str) -> pa.NativeFile:
    filesystem, name = locate(path)
    return filesystem.open_input_file(name)
