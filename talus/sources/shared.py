"""The folder that driver and executors share, and tables staged in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_tidied: set[str] = set()
_shipped: set[str] = set()
_scratch: list[list[str]] = []


def ship(spark: SparkSession) -> None:
    """Gives this package to the workers, once an application, by Spark's file server."""
    app, package = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app not in _shipped and package.is_dir():
        spark.sparkContext.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp(prefix='talus-code-')}/talus", "zip", package.parent, package.name))
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where driver and executors are one process may it be unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="talus-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return f"file://{_own[app]}"


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that the application's end removes, and the end of ``scratch`` if it is made inside."""
    app = spark.sparkContext.applicationId
    top = f"{shared_dir(spark)}/talus/{app}"
    if top not in _tidied:
        fs, where = _hadoop(spark, top)
        fs.deleteOnExit(where)
        _tidied.add(top)
    path = f"{top}/{name}-{uuid.uuid4().hex[:12]}"
    for made in _scratch[-1:]:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, so what is made of them has to be written elsewhere before."""
    _scratch.append(made := [])
    try:
        yield
    finally:
        _scratch.remove(made)
        for path in made:
            fs, where = _hadoop(spark, path)
            fs.delete(where, True)


def written(df: DataFrame, path: str, codec: str = "zstd") -> DataFrame:
    """df, written and read again: lineage ends there, and no lost executor takes it along."""
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df, written to the shared folder and read again."""
    return written(df, new_path(df.sparkSession, name), codec)
