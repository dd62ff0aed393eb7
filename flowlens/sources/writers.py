"""Sinks: text files, catalog tables, result tables and pluggable formats."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions.flows import record_id
from flowlens.schemas import column_types
from flowlens.session import stored
from flowlens.sources.readers import Source


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = "\t", header: bool = True) -> None:
    """Header text files, one per partition."""
    df.write.mode(mode).csv(path, sep=sep, header=header)


def write_single_file(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One part file with one header, in the order of ``df``; Spark's _SUCCESS marks completion.

    The rows are computed and written by all tasks; only the finished part files are then read through one.
    """
    parts = f"{path.rstrip('/')}.parts"
    numbered = df.withColumn("__order", F.monotonically_increasing_id())
    numbered.write.mode("overwrite").parquet(parts)
    rows = df.sparkSession.read.schema(numbered.schema).parquet(parts).coalesce(1).sortWithinPartitions("__order")
    rows.drop("__order").write.mode("overwrite").csv(path, sep=sep, header=True)
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(parts)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append_rows(df: DataFrame, target: Source) -> None:
    """Append to any format (search index, database); errors propagate."""
    writer = df.write.format(target.format).options(**target.options).mode("append")
    writer.save(target.path) if target.path else writer.save()


def append_with_ids(df: DataFrame, target: Source, id_column: str = "recordid") -> None:
    """Append with a generated id per row."""
    append_rows(df.withColumn(id_column, F.uuid()), target)


def to_catalog_types(df: DataFrame, table: str) -> DataFrame:
    """Typed cells of a catalog table: blank, '-1' and unreadable values are left out (null).

    A missing row key is derived from the other cells, so writing the same rows again gives the same keys.
    """
    types = column_types(table)
    names = [c for c in df.columns if c in types]

    def cell(name: str) -> Column:
        text = F.trim(F.col(name).cast("string"))
        kept = F.when((text != "") & (text != "-1"), text)
        return kept.try_cast(types[name].simpleString()).alias(name)

    typed = [cell(c) for c in names if c != "ROW"]
    key = F.col("ROW").cast("string") if "ROW" in df.columns else record_id(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    return df.select(key.alias("ROW"), *typed)


def write_catalog_table(df: DataFrame, table: str, target: Source) -> None:
    """Appends to a catalog table. A store with row keys replaces rows of equal key (``file_store.latest``); plain files do not."""
    append_rows(to_catalog_types(df, table), target)


# Stored types of the two result tables.
FLOW_RESULT = {
    "srcip": "string", "dstip": "string", "attacktype": "string", "recordtime": "timestamp", "proto": "string",
    "srcport": "int", "dstport": "int", "flownums": "int", "flownuma": "int",
}
URL_RESULT = {
    "id": "string", "date": "timestamp", "srcip": "string", "dstip": "string", "uri": "string", "url": "string",
    "predictionnb": "double", "probabilitynb": "double", "predictionlr": "double", "probabilitylr": "double",
}


def typed_results(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Distinct typed results; whole numbers may come as decimals."""

    def cell(name: str, kind: str) -> Column:
        if kind == "int":
            return F.floor(F.col(name).try_cast("double")).try_cast("int").alias(name)
        return F.col(name).try_cast(kind).alias(name)

    return df.select(*[cell(n, k) for n, k in layout.items()]).dropDuplicates()


def save_results(df: DataFrame, layout: dict[str, str], targets: list[Source], key: list[str]) -> None:
    """Distinct typed results with a stable id, to every target; computed once."""
    out = typed_results(df, layout)
    out = out.withColumn("recordid", record_id(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))
    if len(targets) > 1:
        out = stored(out, "results")
    for target in targets:
        append_rows(out, target)


def route(name: str) -> tuple[str, str]:
    """Kind and table of a result file ``TABLE@DAY@LABEL``: flow results, URL results or a catalog table."""
    table, _, label = (p.strip() for p in name.split("@"))
    # Labels of the two result kinds.
    return {"NET.csv": "flow", "MONI.csv": "url"}.get(label, "catalog"), table


def write_routed(df: DataFrame, name: str, flow_targets: list[Source], url_targets: list[Source], catalog: Source) -> str:
    """Write a result file's rows to where its name sends them; returns the kind."""
    kind, table = route(name)
    if kind == "flow":
        save_results(df, FLOW_RESULT, flow_targets, list(FLOW_RESULT))
    elif kind == "url":
        save_results(df, URL_RESULT, url_targets, list(URL_RESULT))
    else:
        write_catalog_table(df, table, catalog)
    return kind


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def write_if_any(df: DataFrame, write) -> bool:
    """Call ``write(df)`` unless there are no rows; says whether it wrote."""
    if df.isEmpty():
        return False
    write(df)
    return True
