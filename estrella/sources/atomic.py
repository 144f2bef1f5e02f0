"""Small files that appear whole or not at all, and of which only one of a name can be made."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file; False if one of that name exists, which then stays as it is.

    The text is written aside and moved onto the name, which must be free: one step on file systems with an atomic
    rename. A writer that stops before leaves a hidden file that nobody reads.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = hadoop.Path(path)
    fs = target.getFileSystem(conf)
    folder = target.getParent()
    fs.mkdirs(folder)
    aside = hadoop.Path(folder, f".{uuid.uuid4().hex}")
    out = fs.create(aside)
    out.write(bytearray(text, "utf-8"))
    out.close()
    files = hadoop.FileContext.getFileContext(aside.toUri(), conf)
    try:
        files.rename(aside, target, spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0))
    except Exception:
        fs.delete(aside, False)
        if fs.exists(target):
            return False
        raise
    return True
