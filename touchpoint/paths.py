"""Opening single objects on any file system Spark or Arrow can reach."""

from __future__ import annotations

import posixpath
from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql import SparkSession


def is_folder(spark: SparkSession, path: str) -> bool:
    """Asked through Hadoop, so every scheme of the cluster works."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.exists(hadoop_path) and system.getFileStatus(hadoop_path).isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    return [entry.getPath().getName() for entry in listed]


def folder_files(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """Path, name and length of every file directly below a folder, whatever its name."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    return [(e.getPath().toString(), e.getPath().getName(), e.getLen()) for e in listed if e.isFile()]


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and authority that Spark itself would use for it; ask before handing a path to tasks."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path).toString()


#: Schemes of Hadoop connectors and what Arrow calls the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a qualified path. A path without a scheme is refused: it would be each worker's own disk."""
    scheme = urlparse(path).scheme
    if not scheme:
        raise ValueError(f"path without a scheme, qualify it on the driver: {path}")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + path[len(scheme):])


def open_input(path: str):
    system, inner = _resolve(path)
    return system.open_input_stream(inner)


def write_object(root: str, name: str, data: bytes) -> None:
    """Write one object below ``root``, replacing what is there."""
    if not is_safe_name(name):
        raise ValueError(f"object name leaves its folder: {name}")
    system, inner = _resolve(f"{root.rstrip('/')}/{name}")
    system.create_dir(posixpath.dirname(inner), recursive=True)
    with system.open_output_stream(inner) as stream:
        stream.write(data)


def is_safe_name(name: str) -> bool:
    return bool(name) and not name.startswith("/") and ".." not in name.split("/")
