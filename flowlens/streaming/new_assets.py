"""Asset discovery as a stream: addresses are reported when they are first seen, by keyed state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowlens.operators.assets import destination_candidates, source_candidates


def first_seen(flows: DataFrame, known: DataFrame, ranges: list[tuple[str, str]]) -> DataFrame:
    """New addresses with their side and the flow that showed them first; ``flows`` may be a stream.

    As a stream the pairs of address and side that were reported are keys of the state store: the state grows with the
    addresses only, no batch reads earlier output, and a restart goes on from the checkpoint.
    """

    def of(candidates: DataFrame, side: str) -> DataFrame:
        def column(name: str, alias: str) -> Column:
            return F.col(name).alias(alias)

        return candidates.select(
            column(f"{side}ip", "ip"), F.lit(side).alias("side"), column("recordtime", "storagetime"), column("proto", "protocol"),
            column(f"{side}port", "port"), column("packernum", "packagenum"))

    both = of(source_candidates(flows, known, ranges), "src").unionByName(of(destination_candidates(flows, known, ranges), "dst"))
    return both.dropDuplicates(["ip", "side"]).withColumns({"isnew": F.lit(1), "flg": F.lit(0)})


def stream_new_assets(
    flows: DataFrame, known: DataFrame, ranges: list[tuple[str, str]], out: str, checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append newly seen addresses to the Parquet table ``out``; every address and side appears there once.

    The sink commits the files of a batch together with its number, so a batch that is run again adds nothing twice.
    """
    writer = first_seen(flows, known, ranges).writeStream.format("parquet").outputMode("append").option("path", out).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
