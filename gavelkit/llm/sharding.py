"""Reproducible shuffle into shards: a Feistel permutation of the global row numbers, with cycle walking.

A row's number is its place in a total order of the table. The permutation moves number ``r`` to place ``p``; the row goes
to shard ``p mod shards`` and slot ``p div shards``. So shard sizes differ by one at most, slots have no gaps, and any
row's shard and slot can be computed from its number alone, and back (``row_at``), without a pass over the data.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavelkit.llm.common import new_name
from gavelkit.session import pinned

ROUNDS = 6


def domain(rows: int) -> tuple[int, int]:
    """Sides a, b of the Feistel domain: a * b is at least ``rows`` and exceeds it by less than a."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    return a, max(1, -(-rows // a))


def _mix(key: str, i: Column, x: Column, side: int) -> Column:
    """48 bits of an md5 of key, round and half, within ``side``."""
    text = F.concat_ws(":", F.lit(key), i.cast("string"), x.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint") % F.lit(side)


def _pass(x: Column, rows: int, key: str, back: bool = False) -> Column:
    """One application of the permutation of 0 .. a*b-1, or of its inverse."""
    a, b = domain(rows)

    def step(s: Column, i: Column) -> Column:
        left, right = s["l"], s["r"]
        if back:
            new_left, new_right = F.pmod(left - _mix(key, i, right, a), F.lit(a)), F.pmod(right - _mix(key, i, left, b), F.lit(b))
        else:
            new_left, new_right = (left + _mix(key, i, right, a)) % a, (right + _mix(key, i, left, b)) % b
        return F.when(i % 2 == 1, F.struct(new_left.alias("l"), right.alias("r"))).otherwise(F.struct(left.alias("l"), new_right.alias("r")))

    halves = F.struct(((x - x % b) / F.lit(b)).cast("bigint").alias("l"), (x % b).cast("bigint").alias("r"))
    order = F.sequence(F.lit(ROUNDS), F.lit(1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(order, halves, step, lambda s: s["l"] * F.lit(b) + s["r"])


def permute(number: Column, rows: int, key: str, back: bool = False) -> Column:
    """The place of a row number among ``rows`` places, or with ``back`` the number at a place.

    Cycle walking: while the result lies outside 0 .. rows-1 the permutation is applied again. A cycle passes fewer than a
    places outside before it is back inside, so a walk of a steps always ends inside; only about one row in a needs any.
    """
    a, _ = domain(rows)
    first = _pass(number, rows, key, back)
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(a)), first, lambda p, _: F.when(p < rows, p).otherwise(_pass(p, rows, key, back)))
    return F.when(first < rows, first).otherwise(walk)


def numbered(df: DataFrame, order: list[str], number: str = "row_number") -> DataFrame:
    """``df`` with gapless row numbers from 0 in the order of the columns ``order``, nulls first.

    Rows are dealt out by range and sorted, then written once with their place inside their partition; a table of one row
    per partition gives where each begins. No task sees more than its range. Rows that are alike in ``order`` are told
    apart by where they were read, so a value that very many rows share doesn't fill one range.
    """
    tie, at, mine, start = (new_name(df, f"gk_{x}") for x in ("read_at", "place", "part", "from"))
    sort = [F.col(c) for c in [*order, tie]]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = pinned(dealt.drop(tie).withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(F.col(at), 33)
    before = Window.orderBy(mine).rowsBetween(Window.unboundedPreceding, -1)
    begins = dealt.groupBy(part.alias(mine)).agg(F.count("*").alias("n")).select(mine, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    begins = pinned(begins, "begins")
    place = F.col(start) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return dealt.join(begins, part == F.col(mine)).withColumn(number, place).drop(at, mine, start)


def shard_rows(df: DataFrame, order: list[str], shards: int, key: str = "shuffle-1") -> DataFrame:
    """``df`` with ``shard`` (0 .. shards-1) and ``slot`` (gapless from 0 in each shard), shuffled by ``key``.

    The law is ``rows``: shards differ by one row at most. The same rows, order, key and count give the same result on any
    cluster. An empty table gives an empty result; null values sort first; rows that are equal in ``order`` are
    interchangeable. Columns of ``df`` named like a result column are replaced.
    """
    table = numbered(df, order)
    rows = table.count()
    if rows == 0:
        return table.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("bigint")})
    to = new_name(table, "gk_to")
    place = table.withColumn(to, permute(F.col("row_number"), rows, key))
    return place.withColumns({"shard": (F.col(to) % shards).cast("int"), "slot": ((F.col(to) - F.col(to) % shards) / shards).cast("bigint")}).drop(to)


def row_at(shard: Column, slot: Column, rows: int, shards: int, key: str = "shuffle-1") -> Column:
    """The row number that ``shard_rows`` puts at a slot, for readers that resume or jump."""
    return permute(slot * shards + shard, rows, key, back=True)
