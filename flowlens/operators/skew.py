"""Joins and group statistics that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_SHARE = 0.001  # a key is hot from this share on, so there are at most 1 / HOT_SHARE hot keys
HOT_ROWS = 100_000  # and never below this many rows


def _same(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


def _pieces(grouped: DataFrame) -> Column:
    """Pieces a key of ``grouped`` (with its rows in ``__n``) is cut into; a piece is at most a hot key's least size."""
    piece = F.greatest(F.lit(HOT_ROWS), grouped.agg(F.sum("__n") * HOT_SHARE).scalar())
    return F.ceil(F.col("__n") / piece).cast("int")


def hot_keys(df: DataFrame, keys: list[str], tag: str = "h") -> DataFrame:
    """Keys that need more than one piece, as ``__<tag>_<key>``, with their ``__salts``; at most 1 / HOT_SHARE rows."""
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    found = grouped.withColumn("__salts", _pieces(grouped)).where("__salts > 1")
    return found.select(*[F.col(k).alias(f"__{tag}_{k}") for k in keys], "__salts")


def with_salts(df: DataFrame, hot: DataFrame, keys: list[str], tag: str = "h") -> DataFrame:
    """Rows with the number of pieces of their key, 1 for cold keys; the hot keys are few and broadcast."""
    met = _same([F.col(k) for k in keys], [F.col(f"__{tag}_{k}") for k in keys])
    joined = df.join(F.broadcast(hot), met, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__salts", F.lit(1)).alias("__salts"))


def row_salt(by: str, salts: Column) -> Column:
    """Salt 0..salts-1 from one column that tells the rows of a key apart.

    It depends on the row's content only, so a retried task produces the same one, and it reads no other column.
    """
    return row_salt_of(F.xxhash64(F.col(by)), salts)


def row_salt_of(number: Column, salts: Column) -> Column:
    # never null: Spark would else repeat the whole expression in a filter at the scan
    return F.coalesce(F.pmod(number, salts).cast("int"), F.lit(0))


def splits_skewed_joins(spark: SparkSession) -> bool:
    """Whether Spark splits hot partitions of joins at run time."""
    on = lambda key: str(spark.conf.get(key, "true")).lower() == "true"
    return on("spark.sql.adaptive.enabled") and on("spark.sql.adaptive.skewJoin.enabled")


def salted_lookup(
    facts: DataFrame, dim: DataFrame, on: list[str], by: str, how: str = "left", counted: DataFrame | None = None
) -> DataFrame:
    """Join a big side with a keyed side; a hot key of the big side is spread over as many tasks as its rows need.

    ``by`` is a column of the big side that differs between the rows of a key. Only the keyed rows of hot keys are copied,
    once per piece. With adaptive execution Spark finds and splits them itself, provided that both sides are plain shuffles:
    a salt that is always 0 makes the keyed side one even if it is an aggregate on the same keys. Without it the keys are
    counted beforehand, pre-aggregated, in ``counted`` if the big side is the result of other joins and a table it came from
    has the same keys as often.
    """
    if splits_skewed_joins(facts.sparkSession):
        zero = lambda *c: row_salt_of(F.xxhash64(*c), F.lit(1)).alias("__salt")
        return facts.select("*", zero(by)).join(dim.select("*", zero(*on)), [*on, "__salt"], how).drop("__salt")
    hot = hot_keys(facts if counted is None else counted, on)
    salted = with_salts(facts, hot, on).withColumn("__salt", row_salt(by, F.col("__salts"))).drop("__salts")
    copies = with_salts(dim, hot, on).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


def label_lookup(points: DataFrame, per_label: DataFrame, label: str = "label", how: str = "left", few: bool = False) -> DataFrame:
    """Join points with one row per cluster or quadrant label.

    ``few``: the labels are those of a model (at most 20) or of the quadrants, so their rows are broadcast. A shuffle by label
    would gather the points in a handful of tasks. Labels may also be given with the data: then Spark broadcasts the right side
    if its size allows, else it shuffles both.
    """
    return points.join(F.broadcast(per_label) if few else per_label, label, how)


def with_group_stats(df: DataFrame, keys: list[str], by: str, **stats: Column) -> DataFrame:
    """Each row with aggregates of its group, like an unordered window, but a hot group is never held by one task.

    ``by`` is a column that differs between the rows of a group.

    The aggregates are pre-aggregated before the shuffle. With adaptive execution the rows meet them in one shuffled join,
    whose hot partitions Spark splits (the salt that is always 0 makes the aggregate's side a plain shuffle). Without it hot
    groups (at most ``1 / HOT_SHARE`` of them) are looked up in a broadcast table and their rows are spread by salt; the
    others meet their aggregates in a shuffled join.
    """
    if splits_skewed_joins(df.sparkSession):
        met = [F.col(f"__g_{k}") for k in keys]
        groups = df.groupBy(*keys).agg(*[c.alias(f"__g_{n}") for n, c in stats.items()]).withColumnsRenamed({k: f"__g_{k}" for k in keys})
        groups = groups.withColumn("__g_salt", row_salt_of(F.xxhash64(*met), F.lit(1)))
        rows = df.withColumn("__salt", row_salt(by, F.lit(1)))
        joined = rows.join(groups, _same([F.col(k) for k in keys], met) & (F.col("__salt") == F.col("__g_salt")))
        return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"__g_{s}").alias(s) for s in stats])
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[c.alias(n) for n, c in stats.items()])
    hot_from = F.greatest(F.lit(HOT_ROWS), grouped.agg(F.sum("__n") * HOT_SHARE).scalar())

    def renamed(part: DataFrame, tag: str) -> DataFrame:
        return part.select(
            *[F.col(k).alias(f"__{tag}_{k}") for k in keys], *[F.col(s).alias(f"__{tag}_{s}") for s in stats],
            # always 0, but not a constant: a constant would be folded into the condition and not be a join key
            F.least(F.col("__n"), F.lit(0)).cast("int").alias(f"__{tag}_salt"),
        )

    hot = F.broadcast(renamed(grouped.where(F.col("__n") >= hot_from), "h"))
    cold = renamed(grouped.where(F.col("__n") < hot_from), "c")
    key_cols = [F.col(k) for k in keys]
    step = df.join(hot, _same(key_cols, [F.col(f"__h_{k}") for k in keys]), "left")
    step = step.withColumn(
        "__salt", F.when(F.col("__h_salt").isNotNull(), 1 + row_salt(by, F.lit(1024))).otherwise(F.lit(0))
    )
    met = _same(key_cols, [F.col(f"__c_{k}") for k in keys]) & (F.col("__salt") == F.col("__c_salt"))
    joined = step.join(cold, met, "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[F.coalesce(F.col(f"__h_{s}"), F.col(f"__c_{s}")).alias(s) for s in stats],
    )


def group_pairs(
    entries: DataFrame, key: str, member: str, value: str, keep: Column | None = None, max_block: int = 4096
) -> DataFrame:
    """Unordered member pairs that meet in a key, as ``(key, left, right, left_value, right_value)``.

    ``entries`` holds one row per key and member. The members of a key are cut into blocks of about ``max_block`` rows
    and a task joins one block with another, so a hot key is shared by many tasks. ``keep`` is an extra condition on the
    pair (columns of the left side end in ``_l``, of the right side in ``_r``) applied inside the join.
    """
    sizes = entries.groupBy(key).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(max_block)).cast("int").alias("__blocks")
    )
    blocked = salted_lookup(entries, sizes, [key], member, "inner").withColumn(
        "__b", F.pmod(F.xxhash64(F.col(member)), F.col("__blocks")).cast("int")
    )
    # A cell is a pair of blocks (x <= y). Block x of it goes to the left side, block y to the right side, so two members
    # meet in exactly one cell.
    cell = F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__o")
    celled = blocked.select("*", cell)
    extra = [c for c in entries.columns if c not in (key, member, value)]

    def side(tag: str, x: Column, y: Column, here: Column) -> DataFrame:
        return celled.where(here).select(
            F.col(key).alias(f"__key{tag}"), x.alias(f"__x{tag}"), y.alias(f"__y{tag}"),
            F.col(member).alias(f"{member}{tag}"), F.col(value).alias(f"{value}{tag}"),
            *[F.col(c).alias(f"{c}{tag}") for c in extra],
        )

    b, o = F.col("__b"), F.col("__o")
    left, right = side("_l", b, o, o >= b), side("_r", o, b, o <= b)
    ml, mr = F.col(f"{member}_l"), F.col(f"{member}_r")
    on = (
        (F.col("__key_l") == F.col("__key_r")) & (F.col("__x_l") == F.col("__x_r")) & (F.col("__y_l") == F.col("__y_r"))
        & ((F.col("__x_l") != F.col("__y_l")) | (ml < mr))
    )
    joined = left.join(right, on if keep is None else on & keep)
    swap = ml > mr
    vl, vr = F.col(f"{value}_l"), F.col(f"{value}_r")
    return joined.select(
        F.col("__key_l").alias(key), F.least(ml, mr).alias("left"), F.greatest(ml, mr).alias("right"),
        F.when(swap, vr).otherwise(vl).alias("left_value"), F.when(swap, vl).otherwise(vr).alias("right_value"),
    )
