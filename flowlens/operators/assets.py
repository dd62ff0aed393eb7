"""Discovery of addresses that are not in the asset register yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.ip import in_ranges
from flowlens.operators.joins import drop_listed, latest_records


def known_assets(register: DataFrame, found: DataFrame) -> DataFrame:
    """Registered addresses (status other than 2) and addresses found before (flag other than 1)."""
    return (
        register.where(F.col("status") != 2).select("ip").unionByName(found.where(F.col("flg") != 1).select("ip"))
    )


def source_candidates(flows: DataFrame, known: DataFrame, ranges: list[tuple[str, str]]) -> DataFrame:
    """Flows from an unknown address of the ranges, any protocol but ICMP."""
    hit = in_ranges(F.col("srcip"), ranges) & ~F.col("proto").eqNullSafe("ICMP")
    return drop_listed(flows.where(hit), known, "srcip")


def destination_candidates(flows: DataFrame, known: DataFrame, ranges: list[tuple[str, str]]) -> DataFrame:
    """TCP flows of more than two packets to an unknown address of the ranges."""
    hit = in_ranges(F.col("dstip"), ranges) & (F.col("proto") == "TCP") & (F.col("packernum").try_cast("double") > 2)
    return drop_listed(flows.where(hit), known, "dstip")


def new_assets(candidates: DataFrame, side: str) -> DataFrame:
    """Latest record of each new address, seen as source ('src') or destination ('dst') of a flow."""
    latest = latest_records(
        candidates, f"{side}ip", "recordtime", protocol=F.col("proto"), port=F.col(f"{side}port"), packagenum=F.col("packernum")
    )
    return latest.withColumns({"isnew": F.lit(1), "flg": F.lit(0)})
