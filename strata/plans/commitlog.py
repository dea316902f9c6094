"""Numbered commit log of a layer.

``<root>/<layer>/_commits`` holds one small JSON file per commit, named by its number.  A
writer claims the next number by putting a complete file under that name only if there is
none (a compare-and-set): of two writers that try the same number one gets it, the other
takes the next.  So commits are in one order, whatever the clocks say, and a reader sees
a record whole or not at all.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

LOG = "_commits"
RECORD = ("version long, batch_id string, table_name string, rows_written long, started_at timestamp_ntz, "
          "loaded_at timestamp_ntz, seconds double")


class Written(NamedTuple):
    """A table of a batch, written and not committed yet."""

    batch_id: str
    table_name: str
    rows_written: int
    started_at: dt.datetime
    loaded_at: dt.datetime     # the stamp of the rows
    seconds: float             # duration of the load


class CommitConflict(RuntimeError):
    """Another batch was committed since the one a refresh was based on."""


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def log_path(root: str, layer: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{LOG}"


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return jpath, jpath.getFileSystem(conf), conf


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make ``path`` a file with this text, unless it exists; False if it did.

    The file is written aside and then given its name in one step: by a hard link on a mounted
    file system, elsewhere by a rename that refuses an existing target.
    """
    jpath, fs, conf = _file_system(spark, path)
    if fs.getUri().getScheme() == "file":
        return _link_if_absent(jpath.toUri().getPath(), text)
    return _rename_if_absent(spark, jpath, fs, conf, text)


def _link_if_absent(path: str, text: str) -> bool:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    aside = f"{os.path.dirname(path)}/.{os.path.basename(path)}.{uuid.uuid4().hex}"
    with open(aside, "w") as out:
        out.write(text)
        out.flush()
        os.fsync(out.fileno())
    try:
        os.link(aside, path)
        return True
    except FileExistsError:
        return False
    finally:
        os.unlink(aside)


def _rename_if_absent(spark: SparkSession, jpath, fs, conf, text: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    aside = hadoop.Path(jpath.getParent(), f".{jpath.getName()}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    keep = spark.sparkContext._gateway.new_array(rename, 1)
    keep[0] = rename.NONE
    try:
        hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(aside), fs.makeQualified(jpath), keep)
        return True
    except Exception as e:
        if "FileAlreadyExists" not in str(e):
            raise
        return False
    finally:
        if fs.exists(aside):
            fs.delete(aside, False)


def last_version(spark: SparkSession, root: str, layer: str) -> int:
    """Number of the newest commit, 0 without any."""
    folder, fs, _ = _file_system(spark, log_path(root, layer))
    if not fs.exists(folder):
        return 0
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)


def version_path(root: str, layer: str, version: int) -> str:
    return f"{log_path(root, layer)}/{version:020d}.json"


def commit(spark: SparkSession, root: str, layer: str, tables: list[Written], after: int | None = None) -> DataFrame:
    """Append the record of a batch under the next free number; returns it.

    ``after``: the commit that the batch was derived from; if another one came since,
    :class:`CommitConflict` is raised and nothing is committed.
    """
    while True:
        last = last_version(spark, root, layer)
        if after is not None and last != after:
            raise CommitConflict(f"layer {layer}: commit {last} came after {after}")
        rows = [(last + 1, *t) for t in tables]
        names = ("version", *Written._fields)
        text = "".join(json.dumps({k: v.isoformat(timespec="microseconds") if isinstance(v, dt.datetime) else v
                                   for k, v in zip(names, r, strict=True)}) + "\n" for r in rows)
        if put_if_absent(spark, version_path(root, layer, last + 1), text):
            return spark.createDataFrame(rows, RECORD)


def commits(spark: SparkSession, root: str, layer: str, version: int | None = None) -> DataFrame:
    """All commit records of a layer, or those of one commit."""
    return spark.read.schema(RECORD).json(log_path(root, layer) if version is None else version_path(root, layer, version))


def current_batch(spark: SparkSession, root: str, layer: str) -> str:
    """The batch of the commit with the largest number."""
    last = last_version(spark, root, layer)
    if not last:
        raise FileNotFoundError(f"no committed batch of layer {layer} under {root}")
    return commits(spark, root, layer, last).first()["batch_id"]
