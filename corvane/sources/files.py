"""Folders that the driver and all executors share, and single files in them."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's URI in spark.checkpoint.dir; in a temporary one only where that is unset and the master is local."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="corvane-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_file(uri: str, data: bytes) -> None:
    if uri.startswith(("/", "file:")):
        fs, path = pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    else:
        fs, path = pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(data)
