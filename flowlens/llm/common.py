"""Table access, batch handling and file access shared by the operators of this package."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowlens.session import stored

#: Rows of one Arrow batch sent to a Python worker: texts may be long, so few of them are in memory at once.
BATCH_ROWS = 512
#: Texts are handled in slices of at most this many characters (a longer text is a slice of its own).
SLICE_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Python worker holds; a session that sets a smaller number keeps it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def in_id_order(docs: DataFrame) -> DataFrame:
    """doc_id and text (null: empty), dealt in ranges and sorted by id; rows of one id, or of none, are dealt by their texts."""
    order = ["doc_id", F.xxhash64("text")]
    return docs.select("doc_id", text_of().alias("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Consecutive rows with their texts, about SLICE_CHARS characters at a time."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
        start = size = 0
        for i, t in enumerate(texts):
            if size and size + len(t) > SLICE_CHARS:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        yield batch.slice(start), texts[start:]


def stored_with(df: DataFrame, name: str, **numbers: Column) -> tuple[DataFrame, dict]:
    """``stored`` rows, and aggregates of them that are taken while they are written; ``rows`` is always their number."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in numbers.items()]), name)
    return out, seen.get


def filesystem(uri: str):
    """pyarrow file system and path of a URI or plain path, for use inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_whole(uri: str, write) -> None:
    """Calls ``write(stream)`` on a new file and gives it its name only when complete, so a retried task does no harm."""
    import uuid

    files, path = filesystem(uri)
    files.create_dir(posixpath.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        write(out)
    files.move(part, path)
