"""The batch operators as continuous jobs with Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from gavelkit.functions import fixed
from gavelkit.operators.store import mark_missing, merge_listing_days
from gavelkit.sources.stores import VersionedStore


def upsert_stream(
    batches: DataFrame,
    store: VersionedStore,
    checkpoint: str,
    order: list[str],
    run_date: Callable[[DataFrame], str] | None = None,
    rules=None,
    once: bool = True,
) -> StreamingQuery:
    """Merge landed listing batches into a versioned store as they arrive.

    ``batches`` carries ``run_date``. Each version keeps the name of its batch, which is the query's
    id, kept in the checkpoint, and the batch's number: a batch that runs again after a failure
    changes nothing, and a new checkpoint on the same store, also at the path of a lost one, goes on
    from its latest version. A batch of earlier days than the store's is merged as late rows.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId").replace("-", "")[:12]
        tag = f"{stream}-{batch_id}"
        if tag in store.tags():
            return
        known = store.read()
        days = batch.select(F.col("run_date").alias("d")).unionByName(known.select(F.col("last_seen").alias("d")))
        last = days.agg(F.max("d")).first()[0]
        if last is None:
            return
        current = mark_missing(merge_listing_days(known, batch, "run_date", order, rules), last)
        store.write(current, max(store.versions(), default=0) + 1, tag)

    writer = batches.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


_SEEN = StructType(
    [
        StructField("id", StringType()), StructField("first_seen", StringType()), StructField("last_seen", StringType()),
        StructField("times_seen", IntegerType()), StructField("last_price", DoubleType()), StructField("status", StringType()),
    ]
)
# the listings of a bucket as JSON: [id, first_seen, last_seen, times_seen, last_price, time of the last price, days already
# counted that the watermark still lets in, time-out or null]
_STATE = StructType([StructField("listings", StringType())])
_NO_TIME = -(1 << 63)


def lifecycle_stream(sightings: DataFrame, quiet: str = "7 days", late: str = "1 day", buckets: int = 2048) -> DataFrame:
    """Keep first and last day, days seen and last price per listing; report changes.

    ``sightings``: id, ts, date, price. A listing not seen for ``quiet`` becomes inactive when
    the watermark passes; its numbers stay, so one that returns goes on counting. Rows of a bucket
    arrive in chunks and only a few numbers a listing are kept, so a busy one does not fill memory. The price
    is that of the latest time, whenever its row arrives; a late day counts once, as any other.

    Listings share state in ``buckets`` by a hash of their id, since each state costs milliseconds of conversion: the
    number, fixed for a checkpoint, should leave some hundred listings a bucket. A bucket's timer is that of its listing
    which times out first.
    """
    quiet_ms = int(pd.Timedelta(quiet).total_seconds() * 1000)

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        held = {x[0]: x[1:] for x in json.loads(state.get[0])} if state.exists else {}
        seen = {}
        if not state.hasTimedOut:
            for rows in chunks:
                times = rows["ts"].to_numpy("datetime64[us]").astype("int64").tolist()
                dates, prices = rows["date"].tolist(), rows["price"].tolist()
                has_price = rows["price"].notna().tolist()
                for id_, ts, date, price, priced in zip(rows["id"].tolist(), times, dates, prices, has_price, strict=True):
                    if id_ not in seen:
                        seen[id_] = [set(), 0, None, None]
                    new = seen[id_]
                    if date is not None:
                        new[0].add(date)
                    if ts != _NO_TIME:
                        new[1] = max(new[1], ts)
                        if priced and (new[2] is None or ts > new[2]):
                            new[2], new[3] = ts, price
        open_from = datetime.fromtimestamp(now / 1000, UTC).strftime("%Y-%m-%d")
        out = []
        for id_, (days, newest, at, new_price) in seen.items():
            first, last, times, price, price_ms, known, _ = held.get(id_, (None, None, 0, None, None, [], None))
            if at is not None and (price_ms is None or at // 1000 > price_ms):
                price_ms, price = at // 1000, float(new_price)
            counted = set(known)
            times += len(days - counted)
            first, last = min([first, *days] if first else days, default=None), max([last, *days] if last else days, default=None)
            held[id_] = (first, last, times, price, price_ms, sorted(d for d in days | counted if d >= open_from), max(newest // 1000, now) + quiet_ms)
            out.append((id_, first, last, times, price, "active"))
        for id_, x in held.items():
            if x[-1] is not None and x[-1] < now:
                held[id_] = (*x[:-1], None)  # without a new time-out
                out.append((id_, *x[:4], "inactive"))
        state.update((json.dumps([(id_, *x) for id_, x in held.items()]),))
        until = min((x[-1] for x in held.values() if x[-1] is not None), default=None)
        if until is not None:
            state.setTimeoutTimestamp(max(until, now + 1))
        if out:
            yield pd.DataFrame(out, columns=_SEEN.fieldNames())

    return (
        sightings.withWatermark("ts", late)
        .withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(step, _SEEN, _STATE, "update", GroupStateTimeout.EventTimeTimeout)
    )


def alert_stream(listings: DataFrame, threshold: float = fixed.ALERT_THRESHOLD, late: str = "1 day") -> DataFrame:
    """Listings at or above the threshold, each reported once. ``listings``: id, ts, price."""
    return listings.withWatermark("ts", late).where(F.col("price") >= threshold).dropDuplicatesWithinWatermark(["id"])


def daily_price_stream(prices: DataFrame, group: str, late: str = "1 day") -> DataFrame:
    """Count, total, min and max of plausible prices per day and group; late rows are bounded.

    Partial aggregation runs before the shuffle, so one busy group does not load one task.
    """
    return (
        prices.withWatermark("ts", late)
        .where(F.col("price") >= fixed.PRICE_FLOOR)
        .groupBy(F.window("ts", "1 day"), group)
        .agg(
            F.count("*").alias("n"), F.sum("price").alias("total"), F.min("price").alias("min_price"),
            F.max("price").alias("max_price"),
        )
        .select(F.col("window.start").cast("date").cast("string").alias("day"), group, "n", "total", "min_price", "max_price")
    )


def session_stream(sightings: DataFrame, key: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """Sessions of a key: rows (``ts``, price) with no pause of ``gap`` or more between them, put out when the watermark has passed.

    Open sessions merge in the state store, so a late row may join two of them. A null key is a key; prices may be null.
    """
    held = sightings.withWatermark("ts", late).groupBy(F.session_window("ts", gap), key)
    found = held.agg(F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count("*").alias("n"), F.min("price").alias("low"), F.max("price").alias("high"))
    return found.select(key, "started", "ended", "n", "low", "high")


def price_count_stream(prices: DataFrame, group: str, late: str = "1 day") -> DataFrame:
    """How often each plausible price stood in a day and group: what an exact median needs, and mergeable.

    State is a row for each distinct price of the open days, so a busy group is spread over all tasks.
    """
    open_days = prices.withWatermark("ts", late).where(F.col("price") >= fixed.PRICE_FLOOR)
    counts = open_days.groupBy(F.window("ts", "1 day"), group, "price").agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").cast("date").cast("string").alias("day"), group, "price", "n")


def daily_median(counts: DataFrame, group: str, slices: int = 200) -> DataFrame:
    """Exact median of each day and group from ``price_count_stream``: day, group, n, median (even counts: rounded mean).

    A first pass adds up counts by price slice (``slices`` to a factor of e) and finds those of the middle ranks; a second
    reads only these slices. So no group's prices are sorted as a whole. Counts of a price may come in several rows.
    """
    keys = ["day", group]
    spot = counts.withColumn("_slice", F.floor(F.log("price") * slices))
    summed = spot.groupBy(*keys, "_slice").agg(F.sum("n").alias("_n"))
    upto, whole = Window.partitionBy(*keys).orderBy("_slice"), Window.partitionBy(*keys)
    ranked = summed.withColumns({"_before": F.sum("_n").over(upto) - F.col("_n"), "n": F.sum("_n").over(whole)})
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    holds = lambda rank, before, n: (before < rank) & (rank <= before + n)
    middle = ranked.where(holds(low, F.col("_before"), F.col("_n")) | holds(high, F.col("_before"), F.col("_n"))).select(*keys, "_slice", "_before", F.col("n").alias("_total"))
    prices = spot.groupBy(*keys, "_slice", "price").agg(F.sum("n").alias("n"))
    same = [prices[k].eqNullSafe(middle[k]) for k in [*keys, "_slice"]]
    near = prices.join(middle, reduce(and_, same)).select(*[prices[k] for k in [*keys, "_slice"]], "price", F.col("n").alias("_n"), "_before", F.col("_total").alias("n"))
    at = F.col("_before") + F.sum("_n").over(Window.partitionBy(*keys, "_slice").orderBy("price")) - F.col("_n")
    near = near.withColumn("_at", at)
    one = lambda rank: F.max(F.when(holds(rank, F.col("_at"), F.col("_n")), F.col("price")))
    ends = near.groupBy(*keys, "n").agg(one(low).alias("_low"), one(high).alias("_high"))
    mean = F.floor((F.col("_low") + F.col("_high")) / 2 + 0.5).cast("double")
    return ends.select(*keys, "n", F.when(F.col("n") % 2 == 1, F.col("_low")).otherwise(mean).alias("median"))


def listing_day_stream(listings: DataFrame, late: str = "1 day") -> DataFrame:
    """Each listing's highest price of a day (dealer, day, id, price), held back until the day has closed for all.

    ``listings``: id, dealer, ts, price.
    """
    days = listings.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), "dealer", "id").agg(F.max("price").alias("price"))
    return days.select("dealer", F.col("window.start").cast("date").cast("string").alias("day"), "id", "price")


def alerts_after_import(days: DataFrame, threshold: float = fixed.ALERT_THRESHOLD, more_than: int = fixed.BACKFILL_SUSPECT) -> DataFrame:
    """New listings at or above the threshold on their first day (dealer, day, id, price), from ``listing_day_stream``.

    A dealer's first day brings its whole stock: with more than ``more_than`` listings it is an import, and none of them is
    reported, on that day or later. Everything is decided per closed day, so late rows of an open day can't change it.
    """
    firsts = days.groupBy("dealer", "id").agg(F.min("day").alias("day"), F.min_by("price", "day").alias("price"))
    stock = days.groupBy("dealer", "day").agg(F.count("*").alias("_n"))
    imports = stock.groupBy("dealer").agg(F.min("day").alias("day"), F.min_by("_n", "day").alias("_n")).where(F.col("_n") > more_than)
    return firsts.where(F.col("price") >= threshold).join(imports.select("dealer", "day"), ["dealer", "day"], "left_anti").select("dealer", "day", "id", "price")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and read its result table back."""
    spark = stream.sparkSession
    if mode == "append":
        q = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    else:
        q = stream.writeStream.outputMode(mode).foreachBatch(
            lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/run={n}")
        )
    q.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path) if mode == "append" else spark.read.option("basePath", path).parquet(f"{path}/run=*")
