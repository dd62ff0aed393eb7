"""Traffic baselines per address and their verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.joins import with_baseline
from flowlens.session import cut_lineage

KB = 1024


def _level(names: dict[int, str]) -> Column:
    out = None
    for gid, name in names.items():
        cond = F.col("__g") == gid
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out


def day_baseline(flows: DataFrame) -> DataFrame:
    """Largest packets and KB per (ip, hour) and per (ip, proto, hour).

    Maxima of maxima: the fine level is aggregated once and the coarse level reads only its rows.
    """
    fine = flows.groupBy(F.col("srcip").alias("name"), "proto", "hour").agg(
        F.max(F.col("packernum").cast("double")).alias("pk"), F.max(F.col("bytesize").cast("double")).alias("by")
    )
    return _day_maxima(fine)


def _day_maxima(fine: DataFrame) -> DataFrame:
    levels = fine.groupingSets([["name", "proto", "hour"], ["name", "hour"]], "name", "proto", "hour").agg(
        F.max("pk").alias("connectavg"), (F.max("by") / KB).alias("netflowavg"), F.grouping_id().alias("__g")
    )
    return levels.select(
        "name", F.when(F.col("__g") == 0, F.col("proto")).otherwise("").alias("proto"), "hour", "connectavg", "netflowavg",
        _level({0: "proto", 2: "all"}).alias("baseline"),
    )


def fine_moments(**values: Column) -> list[Column]:
    """Count, mean and squared deviations of every value, from which coarser levels are merged."""
    out = []
    for name, v in values.items():
        out += [F.count(v).alias(f"{name}_n"), F.avg(v).alias(f"{name}_mean"), (F.var_pop(v) * F.count(v)).alias(f"{name}_dev")]
    return out


def merged_mean(name: str) -> Column:
    return F.sum(F.col(f"{name}_mean") * F.col(f"{name}_n")) / F.sum(f"{name}_n")


def merged_deviation(name: str) -> Column:
    """Sample deviation over the merged rows; null below two of them."""
    n, mean = F.sum(f"{name}_n"), merged_mean(name)
    between = F.sum(F.col(f"{name}_mean") * F.col(f"{name}_mean") * F.col(f"{name}_n")) - n * mean * mean
    return F.when(n > 1, F.sqrt(F.greatest(F.sum(f"{name}_dev") + between, F.lit(0.0)) / (n - 1)))


def week_baseline(flows: DataFrame) -> DataFrame:
    """Upper bounds mean + 3 sample deviations per (ip, hour) and (ip, proto, hour); a single row takes 3 global means.

    The flows are read once, for the fine level; the coarse level and the global means are merged from its rows.
    """
    return _week_bounds(cut_lineage(flows.groupBy(F.col("srcip").alias("name"), "proto", "hour").agg(*_moments())))


def _moments() -> list[Column]:
    return fine_moments(pk=F.col("packernum").cast("double"), by=F.col("bytesize").cast("double") / KB)


def _week_bounds(fine: DataFrame) -> DataFrame:
    """Bounds of both levels from moments of the fine level; a key may have several rows, one a day."""
    overall = fine.agg(F.struct(merged_mean("pk").alias("pk"), merged_mean("by").alias("by"))).scalar()
    levels = fine.groupingSets([["name", "proto", "hour"], ["name", "hour"]], "name", "proto", "hour").agg(
        (merged_mean("pk") + 3 * merged_deviation("pk")).alias("up_pk"), (merged_mean("by") + 3 * merged_deviation("by")).alias("up_by"),
        F.grouping_id().alias("__g"),
    )
    return levels.select(
        "name", F.when(F.col("__g") == 0, F.col("proto")).otherwise("").alias("proto"), "hour",
        F.coalesce("up_pk", 3 * overall.getField("pk")).alias("connectup"),
        F.coalesce("up_by", 3 * overall.getField("by")).alias("netflowup"),
        _level({0: "proto", 2: "all"}).alias("baseline"),
    )


def store_days(flows: DataFrame, path: str) -> None:
    """Partials of every (day, ip, proto, hour) in a table partitioned by day: counts, means, squared deviations, maxima.

    Days that the flows hold replace their own partitions, so a run for one day reads and writes that day only, and a run that
    is repeated leaves the same store.
    """
    day = flows.groupBy(F.to_date("recordtime").alias("date"), F.col("srcip").alias("name"), "proto", "hour").agg(
        *_moments(), F.max(F.col("packernum").cast("double")).alias("pk_max"), F.max(F.col("bytesize").cast("double")).alias("by_max"))
    # a day's partials are few beside its flows: few files a day
    day.repartition("date", F.pmod(F.xxhash64("name"), F.lit(8))).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def week_from_store(days: DataFrame) -> DataFrame:
    """``week_baseline`` from the stored days it is given (a filter on ``date`` reads only their partitions)."""
    return _week_bounds(cut_lineage(days.drop("date", "pk_max", "by_max")))


def day_from_store(day: DataFrame) -> DataFrame:
    """``day_baseline`` from one stored day, or the maxima over several."""
    return _day_maxima(day.select("name", "proto", "hour", F.col("pk_max").alias("pk"), F.col("by_max").alias("by")))


def baseline_report(baseline: DataFrame, kind: str) -> DataFrame:
    """Stored layout: fields a baseline kind does not define carry its sentinel (-3 for days, -2 for weeks)."""
    sentinel = F.lit(-3.0 if kind == "daybaseline" else -2.0)
    numbers = ["connectdown", "connectup", "netflowdown", "netflowup", "connectavg", "netflowavg"]
    known = [F.col(n) if n in baseline.columns else sentinel.alias(n) for n in numbers]
    return baseline.select("name", F.lit(kind).alias("index"), "proto", F.col("hour").alias("date"), *known, "baseline")


def judge_flows(day: DataFrame, week: DataFrame) -> DataFrame:
    """Verdict of every day row against the bounds of its (ip, proto, hour)."""
    bounds = week.where(F.col("baseline") == "proto").select(
        F.col("name").alias("srcip"), "proto", "hour", "connectup", "netflowup"
    )
    joined = with_baseline(day, bounds, ["srcip", "proto", "hour"])
    verdict = (
        F.when(F.col("connectup").isNull(), "protoabnormal")
        .when(F.coalesce(F.col("bytesize").cast("double") / KB, F.lit(0.0)) > F.col("netflowup"), "netflowabnormal")
        .when(F.coalesce(F.col("packernum").cast("double"), F.lit(0.0)) > F.col("connectup"), "connectabnormal")
        .otherwise("normal")
    )
    return joined.withColumn("index", verdict).drop("connectup", "netflowup")
