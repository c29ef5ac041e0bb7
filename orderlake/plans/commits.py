"""The warehouse's commit log: one small file per commit, numbered without gaps.

A commit is a file ``<number>.json`` of pointer rows, one JSON object a line, that is created
only if absent.  Whoever creates number n has published; a writer that finds n taken has lost
the race (``Conflict``), reads what the others published and merges again.  So any set of publishers
ends as one of their serial orders, without a lock and whatever crashes in between: a half-written
file has another name, which readers skip.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderlake.config import path_exists

# A pointer: the current files of a table, or of the part of a table that one run brought.
POINTERS = StructType([
    StructField("tbl", StringType(), False),
    StructField("run_id", StringType(), False),
    StructField("path", StringType(), False),
    StructField("rows", LongType(), True),
    StructField("seq", LongType(), False),    # the commit
    StructField("part", StringType(), True),  # of the fact: the run that brought the rows
])


class Conflict(RuntimeError):
    """Another publisher committed first."""


def commit_path(log: str, seq: int) -> str:
    return f"{log}/{seq:020d}.json"


def pointers(spark: SparkSession, log: str) -> DataFrame:
    if not path_exists(spark, log):
        return spark.createDataFrame([], POINTERS)
    return spark.read.schema(POINTERS).json(log)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file whole or not at all; False if it exists.

    The text goes to a file of another name, which then gets the name in one step that fails if it is
    taken: a hard link on a local file system, else the file system's rename without overwrite (as
    atomic as the file system makes it; HDFS does).
    """
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    fs.mkdirs(target.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if target.toUri().getScheme() == "file":
            as_path = jvm.java.nio.file.Paths.get
            jvm.java.nio.file.Files.createLink(as_path(target.toUri()), as_path(draft.toUri()))
        else:
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()).rename(draft, target, options)
        return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    finally:
        fs.delete(draft, False)


def commit(spark: SparkSession, log: str, seq: int, rows: list[tuple]) -> None:
    """Publish the pointers (tbl, run_id, path, rows, part) as commit ``seq``, or raise ``Conflict``."""
    lines = [json.dumps(dict(tbl=t, run_id=r, path=p, rows=n, seq=seq, part=part)) for t, r, p, n, part in rows]
    if not create_if_absent(spark, commit_path(log, seq), "\n".join(lines) + "\n"):
        raise Conflict(f"commit {seq} of {log} was made by another publisher")
