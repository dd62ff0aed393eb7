"""IPv4 arithmetic and range membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.operators.skew import hot_keys, row_salt, with_salts


def ip_to_long(ip: Column) -> Column:
    """Dotted quad as integer; null for anything else.

    The parts are bound as the argument of a function, so the address is derived and split once and not once an octet.
    """

    def number(parts: Column) -> Column:
        octets = [F.get(parts, F.lit(i)).try_cast("bigint") for i in range(4)]
        return F.when(F.size(parts) == 4, octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3])

    return F.get(F.transform(F.array(F.split(F.trim(ip), r"\.")), number), F.lit(0))


def text_to_long(ip: str) -> int:
    a, b, c, d = (int(x) for x in ip.strip().split("."))
    return a * 16777216 + b * 65536 + c * 256 + d


def in_ranges(ip: Column, ranges: list[tuple[str, str]]) -> Column:
    """Inclusive membership in a short configured list of ranges: one expression, no join.

    The number is bound once, whatever the number of ranges.
    """

    def hit(number: Column) -> Column:
        return reduce(
            lambda a, b: a | b,
            [number.between(text_to_long(lo), text_to_long(hi)) for lo, hi in ranges],
            F.lit(False),
        )

    return F.coalesce(F.exists(F.array(ip_to_long(ip)), hit), F.lit(False))


def semi_join_ranges(
    df: DataFrame, ip: str, ranges: DataFrame, by: str, lo: str = "lo", hi: str = "hi"
) -> DataFrame:
    """Rows whose address lies in any row of a range table (columns hold integers); ``by`` tells the rows apart.

    Ranges are cut into /16 cells, so the join is an equi-join on the cell with a range check left over; a table of
    any size works without a nested loop, and the rows of a busy cell are spread by salt.
    """
    number = ip_to_long(F.col(ip))
    keyed = df.withColumns({"__ip": number, "__c": F.shiftright(number, 16)})
    hot = hot_keys(keyed, ["__c"])
    keyed = with_salts(keyed, hot, ["__c"]).withColumn("__salt", row_salt(by, F.col("__salts"))).drop("__salts")
    cells = ranges.select(
        F.explode(F.sequence(F.shiftright(F.col(lo), 16), F.shiftright(F.col(hi), 16))).alias("__c"),
        F.col(lo).alias("__lo"),
        F.col(hi).alias("__hi"),
    )
    cells = with_salts(cells, hot, ["__c"]).select(
        F.col("__c").alias("__cell"), "__lo", "__hi", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1)).alias("__copy"))
    same = (F.col("__c") == F.col("__cell")) & (F.col("__salt") == F.col("__copy"))
    hit = same & F.col("__ip").between(F.col("__lo"), F.col("__hi"))
    return keyed.join(cells, hit, "left_semi").drop("__ip", "__c", "__salt")
