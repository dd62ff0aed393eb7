"""Sources: time ranges, catalog tables, text files, daily directories and pluggable formats."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.windows import day_folder
from flowlens.schemas import REQUIRED_CELLS, column_types


@dataclass(frozen=True)
class Source:
    """Where a relation lives: any Spark format with its options (parquet, csv, jdbc, a search-index connector, ...)."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        return reader.load(self.path) if self.path else reader.load()

    def subquery(self, sql: str, alias: str = "t") -> "Source":
        """The same database with a query pushed down instead of a whole table (jdbc)."""
        return Source(self.format, {**self.options, "dbtable": f"({sql}) {alias}"}, self.path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on whatever file system the path names."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def in_time_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Rows with lo <= column <= hi, both ends included.

    The bounds (not the column) are converted to the column's type, so the comparison is pushed to the source.
    """
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind)))


def read_catalog_table(source: DataFrame, table: str, columns: list[str], typed: bool = True) -> DataFrame:
    """Chosen columns of a catalog table, as strings or typed; unreadable values become null."""
    types = column_types(table)

    def cell(name: str) -> Column:
        text = F.trim(F.col(name).cast("string"))
        kind = types[name].simpleString()
        if not typed or kind == "string":
            return F.col(name).cast("string").alias(name)
        if kind in ("int", "bigint"):
            # whole numbers may be stored as decimals
            number = text.try_cast("double")
            return F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast(kind).alias(name)
        return text.try_cast(kind).alias(name)

    return source.select(*[cell(c) for c in columns])


def with_completeness_flag(df: DataFrame, layout: str) -> DataFrame:
    """Cells of a fixed layout as strings, '-' where missing, and flag '0' if any is missing, else '1'."""
    cells = REQUIRED_CELLS[layout]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() | (F.col(c).cast("string") == "-") for c in cells])
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in cells],
        F.when(missing, "0").otherwise("1").alias("FLAG"),
    )


def only_complete(df: DataFrame, cells: list[str]) -> DataFrame:
    return df.dropna(subset=cells)


def read_tsv(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """Header text file, every column a string."""
    return spark.read.csv(path, sep=sep, header=True)


def read_daily_dirs(spark: SparkSession, base: str, now: datetime, first: int = -7, last: int = -1) -> DataFrame:
    """Union of the daily directories of a day window; days without a directory are skipped."""
    days = [now + timedelta(days=d) for d in range(first, last + 1)]
    paths = [f"{base.rstrip('/')}/{day_folder(d)}" for d in days]
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        raise FileNotFoundError(f"no daily directory between {paths[0]} and {paths[-1]}")
    return read_tsv(spark, present)


def read_text_list(spark: SparkSession, path: str, name: str = "ip") -> DataFrame:
    """Non-blank lines of a one-column text file."""
    return spark.read.text(path).select(F.trim("value").alias(name)).where(F.col(name) != "")


def read_or_rebuild(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Stored intermediate if there is one, else compute and store it."""
    if not path_exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
