"""Writers and the ingest job."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aduana.functions.frames import unused_name
from aduana.operators.filters import DAY_COLUMN, YEAR_PARTITION
from aduana.sources.contracts import Contract, conform
from aduana.sources.readers import read_csv


def _place(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """A path and its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder has ended; one that failed leaves no marker."""
    marker, files = _place(spark, f"{path.rstrip('/')}/_SUCCESS")
    return files.exists(marker)


def _publish(spark: SparkSession, staged: str, path: str) -> None:
    """Let a staged folder take the place of `path`, whose data goes only after that."""
    new, files = _place(spark, staged)
    here, aside = _place(spark, path)[0], _place(spark, f"{staged}-before")[0]
    replaced = files.exists(here)
    if replaced and not files.rename(here, aside):
        raise OSError(f"{path} cannot be replaced")
    if not files.rename(new, here):
        if replaced:
            files.rename(aside, here)
        raise OSError(f"{staged} cannot become {path}")
    if replaced:
        files.delete(aside, True)


def _write(df: DataFrame, path: str, update: bool, save: Callable[[DataFrameWriter, str], None]) -> None:
    """Without `update`, data that is already there in full is left alone and nothing is computed.

    New data is written beside `path`, under a name that readers skip, and takes its place when it is complete: a write that
    fails leaves the old data as it is, and `df` may read `path` itself.
    """
    spark = df.sparkSession
    if not update and _is_complete(spark, path):
        return
    parent, _, name = path.rstrip("/").rpartition("/")
    staged = f"{parent}{'/' if parent or path.startswith('/') else ''}_writing-{uuid.uuid4().hex}-{name}"
    try:
        save(df.write, staged)
    except BaseException:
        place, files = _place(spark, staged)
        files.delete(place, True)
        raise
    _publish(spark, staged, path)


def write_parquet(df: DataFrame, path: str, update: bool = False) -> None:
    _write(df, path, update, lambda writer, place: writer.parquet(place))


def write_csv(df: DataFrame, path: str, update: bool = False) -> None:
    _write(df, path, update, lambda writer, place: writer.option("header", True).csv(place))


# Parts a year is dealt to before adaptive execution merges and splits them; it can split a year no finer than one task before
# the shuffle has rows of it.
_YEAR_PARTS = 16

# What a task is given to sort. Rows are about four times as large in memory as in the shuffle, so the sort stays in memory.
_TASK_SIZE = "24m"


def _by_year(df: DataFrame) -> DataFrame:
    """Facts in the layout of `write_facts`.

    `rebalance` lets adaptive execution split a year that is too big for one task and merge small ones, so
    neither a hot year nor many tiny files result. Within a file rows are sorted by product, which makes
    the row-group statistics selective for code prefixes.
    """
    part = unused_name("_part", df)
    dated = df.withColumns({
        YEAR_PARTITION: F.year("date"), DAY_COLUMN: F.to_date("date"), part: F.expr(f"int(pmod(hash(hts_code, date), {_YEAR_PARTS}))")})
    return dated.hint("rebalance", YEAR_PARTITION, part).drop(part).sortWithinPartitions(YEAR_PARTITION, "hts_code", "date")


@contextmanager
def _tasks_of_a_sort(spark: SparkSession) -> Iterator[None]:
    """Tasks of `_TASK_SIZE` for the writes within."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, _TASK_SIZE)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_facts(df: DataFrame, path: str, update: bool = False) -> None:
    """Facts as Parquet, one folder per calendar year of `date`."""
    with _tasks_of_a_sort(df.sparkSession):
        _write(_by_year(df), path, update, lambda writer, place: writer.partitionBy(YEAR_PARTITION).parquet(place))


def update_facts(df: DataFrame, path: str) -> None:
    """Replace the years that `df` has in a folder of `write_facts`; the files of all other years stay as they are.

    Rows without a date are a folder, too, and replaced if `df` has any. Tasks write to a staging folder, so a job that
    fails leaves all years as they were. `df` must not read the years it replaces.
    """
    writer = _by_year(df).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with _tasks_of_a_sort(df.sparkSession):
        writer.partitionBy(YEAR_PARTITION).parquet(path)


def concat_extracts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of extracts with the same columns, matched by name; duplicates stay."""
    for other in others:
        first = first.unionByName(other)
    return first


def ingest_extracts(
    spark: SparkSession, import_csv: str, export_csv: str, schema: T.StructType, path: str, update: bool = False
) -> None:
    """Import and export CSV extracts to one Parquet folder."""
    extracts = concat_extracts(read_csv(spark, import_csv, schema), read_csv(spark, export_csv, schema))
    write_parquet(extracts, path, update)


def ingest_facts(
    spark: SparkSession, import_csv: str, export_csv: str, contract: Contract, path: str, update: bool = False,
    only_years: bool = False,
) -> None:
    """Import and export CSV extracts in a contract's columns to the layout of `write_facts`, which filters prune.

    `update` replaces all that is there, `only_years` the years that the extracts hold.
    """
    extracts = concat_extracts(read_csv(spark, import_csv, contract.schema), read_csv(spark, export_csv, contract.schema))
    facts = conform(extracts, contract, tuple(contract.columns))
    if only_years:
        update_facts(facts, path)
    else:
        write_facts(facts, path, update)
