"""Stored intermediate tables: computed once, read many times, and safe when executors are lost."""

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from dataclasses import dataclass
from typing import Any
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wordloom.operators.lookup import entry_bytes


def stage_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir, or else the one set on the context."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """A path under the stage root that nothing uses yet."""
    folder = f"{stage_root(spark).rstrip('/')}/wordloom/{uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(folder)
    return f"{folder}/{name}"


_made: ContextVar[list[str] | None] = ContextVar("folders made", default=None)


@contextmanager
def passing_stages(spark: SparkSession) -> Iterator[None]:
    """Deletes the stages made inside when it ends, also by an error: what is read later must not need them."""
    folders: list[str] = []
    token = _made.set(folders)
    try:
        yield
    finally:
        _made.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@dataclass(frozen=True)
class Stage:
    table: DataFrame
    measured: dict[str, Any]


def stage(table: DataFrame, name: str, **measures: Column) -> Stage:
    """Write the table as Parquet and read it back: later plans prune its columns and know its size.

    ``measures`` are aggregates taken in passing by the same write.
    """
    path = new_folder(table.sparkSession, name)
    schema = table.schema
    observation = Observation() if measures else None
    if observation:
        table = table.observe(observation, *[measure.alias(key) for key, measure in measures.items()])
    table.write.parquet(path)
    return Stage(table.sparkSession.read.schema(schema).parquet(path), observation.get if observation else {})


def stage_firsts(firsts: DataFrame, name: str) -> Stage:
    """First-seen rows, with the largest position."""
    return stage(firsts, name, last_seq=F.max("first_seq"))


def stage_dictionary(dictionary: DataFrame, name: str, key: str) -> Stage:
    """A dictionary, with the memory its entries take."""
    return stage(dictionary, name, dictionary_bytes=entry_bytes(key))


def side_by_side(spark: SparkSession, *tasks: Callable[[], Any]) -> list[Any]:
    """Results of tasks that do not need each other, their Spark jobs submitted at the same time."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        started = [pool.submit(copy_context().run, inheritable_thread_target(spark)(task)) for task in tasks]
        return [task.result() for task in started]
