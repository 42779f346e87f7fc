"""Tables that several writers add to: data first, then a numbered commit that only one of them can get.

A commit is a small file that names the folders with its rows. It is made under another name and appears under its number whole and at
once, and never over an existing one. So a writer that worked from commit ``n`` either gets ``n + 1`` or learns that somebody else
did; then it makes its rows again from what is there now. Rows of an attempt that lost are named by no commit.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DIGITS = 12


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _local(spark: SparkSession, path: str) -> str | None:
    """The path on this machine (or a mounted share), if that is where it lies."""
    found, files = _hadoop_path(spark, path)
    whole = files.makeQualified(found).toUri()
    return whole.getPath() if whole.getScheme() == "file" else None


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Make a whole file under a name that must be free; False if it is not.

    Uses hard links on local and mounted file systems, and renaming without overwriting elsewhere. Stores
    that have neither are not fit for this.
    """
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    local = _local(spark, draft)
    if local is not None:
        target = local[: len(local) - (len(draft) - len(path))]
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "x", encoding="utf-8") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(local, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True
    source, files = _hadoop_path(spark, draft)
    out = files.create(source, True)
    out.write(bytearray(text.encode()))
    out.close()
    target, _ = _hadoop_path(spark, path)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(source), files.makeQualified(target), plain)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        files.delete(source, False)
        return False
    return True


def _commit_path(path: str, number: int) -> str:
    return f"{path}/commits/{number:0{_DIGITS}d}.json"


def create(spark: SparkSession, path: str) -> None:
    """A table without rows; fails if there is one."""
    if not create_if_absent(spark, _commit_path(path, 0), json.dumps({"whole": True, "folders": {}})):
        raise FileExistsError(f"there is a table at {path} already")


def latest(spark: SparkSession, path: str) -> int:
    """The number of the newest commit."""
    folder, files = _hadoop_path(spark, f"{path}/commits")
    names = [one.getPath().getName() for one in files.listStatus(folder)]
    return max(int(name[:_DIGITS]) for name in names if name[_DIGITS:] == ".json")


def _live(spark: SparkSession, path: str, number: int | None) -> list[dict]:
    """Commits that hold the table's rows: from the newest one that holds all of them on."""
    schema = "whole boolean, folders map<string, string>"
    found = spark.read.schema(schema).json(f"{path}/commits/*.json").select(
        "*", F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long").alias("number")
    )
    if number is not None:
        found = found.where(F.col("number") <= number)
    # One short row per commit.
    rows = sorted((row.asDict() for row in found.collect()), key=lambda row: row["number"])
    first = max((k for k, row in enumerate(rows) if row["whole"]), default=0)
    return rows[first:]


def read(spark: SparkSession, path: str, kind: str, schema: str, number: int | None = None) -> DataFrame:
    """The rows of one kind, as of commit ``number`` or of now."""
    folders = [row["folders"][kind] for row in _live(spark, path, number) if kind in (row["folders"] or {})]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{folder}" for folder in folders])


def _attempt(spark: SparkSession, path: str, rows: dict[str, DataFrame], number: int, whole: bool) -> bool:
    folders = {kind: f"{kind}-{uuid.uuid4().hex}" for kind in rows}
    for kind, some in rows.items():
        some.write.parquet(f"{path}/{folders[kind]}")
    return create_if_absent(spark, _commit_path(path, number), json.dumps({"whole": whole, "folders": folders}))


def add(
    spark: SparkSession, path: str, make: Callable[[int], dict[str, DataFrame]], base: int | None = None, whole: bool = False
) -> int:
    """Add the rows that ``make`` gives by kind, and return the number of their commit.

    ``make`` is called with the number of the commit to work from (``base``, or the newest), and again with a newer one whenever
    another writer was first.
    """
    while True:
        number = latest(spark, path) if base is None else base
        if _attempt(spark, path, make(number), number + 1, whole):
            return number + 1
        base = None


def merge(spark: SparkSession, path: str, schemas: dict[str, str]) -> int:
    """Write all rows together once more, so that later reads start from there."""
    return add(spark, path, lambda n: {kind: read(spark, path, kind, schema, n) for kind, schema in schemas.items()}, whole=True)
