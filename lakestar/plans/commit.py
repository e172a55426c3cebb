"""Publishing a small file once: create-if-absent, the warehouse's only lock.

A file that exists is complete and never changes, and of several writers of
one name exactly one succeeds:

* a local folder: the finished file is linked to its name, which fails if
  the name is taken;
* HDFS and other file systems with an atomic rename: the finished file is
  renamed without the right to overwrite;
* an object store (``s3a``): one conditional put.
"""

from __future__ import annotations

import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

OBJECT_STORES = ("s3a",)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def listed(spark: SparkSession, folder: str) -> list[tuple[str, int, bool]]:
    """(name, modification time in ms, is a folder) of what lies in ``folder``; empty if it doesn't exist."""
    fs, p = file_system(spark, folder)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime(), s.isDirectory()) for s in fs.listStatus(p)]


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def _taken(exc: Py4JJavaError) -> bool:
    return "FileAlreadyExists" in str(exc.java_exception) or "PreconditionFailed" in str(exc.java_exception)


def create_if_absent(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write ``folder/name`` unless it exists; whether this call wrote it."""
    fs, target = file_system(spark, f"{folder}/{name}")
    scheme, data = fs.getUri().getScheme(), text.encode()
    if scheme == "file":
        local = re.sub(r"^file:/*", "/", folder)
        os.makedirs(local, exist_ok=True)
        temporary = f"{local}/.{name}-{uuid.uuid4().hex}"
        with open(temporary, "wb") as out:
            out.write(data)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(temporary, f"{local}/{name}")
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(temporary)
    jvm = spark._jvm
    try:
        if scheme in OBJECT_STORES:
            out = (fs.createFile(target).overwrite(False)
                   .must("fs.option.create.conditional.overwrite", True).build())
            out.write(data)
            out.close()
            return True
        temporary = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        out = fs.create(temporary, False)
        out.write(data)
        out.close()
        options = jvm.org.apache.hadoop.fs.Options.Rename
        none = spark.sparkContext._gateway.new_array(options, 1)
        none[0] = options.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        try:
            context.rename(temporary, target, none)
        except Py4JJavaError:
            fs.delete(temporary, False)
            raise
        return True
    except Py4JJavaError as exc:
        if _taken(exc):
            return False
        raise
