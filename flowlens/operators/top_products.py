"""Exact top-k inner products of two tables of factors, without multiplying every row of one with every row of the other.

The items lie in blocks by falling length. A user's product with an item is at most the two lengths multiplied, so once the
k-th best product found is above the user's length times the largest length still to come, the user is done. A round
multiplies blocks of the users that are left with the next item blocks, twice as many as the round before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.session import stored

USER_BLOCK, ITEM_BLOCK = 1024, 4096


def _length(v: str) -> Column:
    return F.sqrt(F.aggregate(F.transform(v, lambda x: x.cast("double") * x), F.lit(0.0), lambda s, x: s + x))


def _packed(rows: DataFrame, block: str, tag: str) -> DataFrame:
    """One row per block: ids, and their factors laid end to end."""
    own = F.sort_array(F.collect_list(F.struct("id", "v")))
    return rows.groupBy(block).agg(own.alias("own")).select(
        block, F.transform("own", lambda x: x["id"]).alias(f"{tag}_ids"), F.flatten(F.transform("own", lambda x: x["v"])).alias(f"{tag}_v"))


def _best(pairs_users: DataFrame, pairs_items: DataFrame, k: int) -> DataFrame:
    """(id, new): per user and pair of blocks the k best (-product, item)."""

    def multiply(users: pa.Table, items: pa.Table) -> pa.Table:
        ids, parts = [], []
        if users.num_rows and items.num_rows:
            user, item = (np.array(t.column(f"{n}_ids")[0].as_py(), "i8") for t, n in ((users, "user"), (items, "item")))
            u, v = (t.column(f"{n}_v").combine_chunks().flatten().to_numpy().astype("f8").reshape(len(x), -1)
                    for t, n, x in ((users, "user", user), (items, "item", item)))
            score = u @ v.T
            for i, row in zip(user.tolist(), score):
                at = np.arange(len(item)) if len(item) <= k else np.flatnonzero(row >= np.partition(row, -k)[-k])
                at = at[np.lexsort((item[at], -row[at]))][:k]
                ids.append(i)
                parts.append([{"lack": -x, "item": y} for x, y in zip(row[at].tolist(), item[at].tolist())])
        kind = pa.list_(pa.struct([("lack", pa.float64()), ("item", pa.int64())]))
        return pa.table([pa.array(ids, pa.int64()), pa.array(parts, kind)], ["id", "new"])

    return pairs_users.groupBy("user_block", "block").cogroup(pairs_items.groupBy("user_block", "block")).applyInArrow(
        multiply, "id long, new array<struct<lack: double, item: long>>")


def top_inner_products(users: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(user, item, score): the k items of largest product with every user, of equal ones the smallest ids.

    Both tables: id, v (array of numbers). The driver gets one length per item block.
    """
    spark = users.sparkSession
    n_items, n_users = items.count(), users.count()
    if not n_items or not n_users:
        return spark.createDataFrame([], "user long, item long, score double")
    ranked = items.select(F.col("id").cast("long").alias("id"), "v", _length("v").alias("length"))
    ranked = ranked.repartitionByRange(-(-n_items // ITEM_BLOCK), F.desc("length"), "id").withColumn("block", F.spark_partition_id())
    ranked = stored(ranked, "ranked-items")
    most = [(r[0], r[1]) for r in ranked.groupBy("block").agg(F.max("length")).orderBy("block").collect()]
    blocks = stored(_packed(ranked, "block", "item"), "item-blocks")
    none = F.array().cast("array<struct<lack: double, item: long>>")
    own_block = F.pmod(F.xxhash64("id"), F.lit(-(-n_users // USER_BLOCK))).cast("int")
    active = users.select(F.col("id").cast("long").alias("id"), "v").select("id", "v", _length("v").alias("length"), own_block.alias("user_block"), none.alias("top"))
    active = stored(active, "users")
    done, at, width = [], 0, 1
    while at < len(most):
        here, at, width = most[at : at + width], at + width, 2 * width
        packed = stored(_packed(active, "user_block", "user"), "user-blocks")
        each = F.explode(F.array(*[F.lit(b) for b, _ in here])).alias("block")
        pairs = stored(packed.select("user_block", each), "block-pairs")
        best = _best(packed.select("*", each), pairs.join(blocks, "block"), k)
        new = best.groupBy("id").agg(F.flatten(F.collect_list("new")).alias("new"))
        top = F.slice(F.sort_array(F.concat("top", "new")), 1, k)
        active = stored(active.join(new, "id").select("id", "v", "length", "user_block", top.alias("top")), "users")
        if at < len(most):
            # what is still to come cannot reach the k-th best; rounding is left some room
            reach = F.col("length") * F.lit(most[at][1]) * (1 + 1e-9)
            ready = (F.size("top") == k) & (-F.element_at("top", -1)["lack"] > reach)
            done.append(active.where(ready).select("id", "top"))
            active = active.where(~ready)
            if active.isEmpty():
                active = None
                break
    if active is not None:
        done.append(active.select("id", "top"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(F.col("id").alias("user"), F.inline("top")).select("user", "item", (-F.col("lack")).alias("score"))
