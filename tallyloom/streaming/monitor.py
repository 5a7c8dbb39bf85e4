"""Streaming forms of scoring, monitoring, moving sums, customer state and de-duplication.

Every query runs with an availableNow trigger: it takes what is there, commits, and ends. State and
output live below the shared folder, so a restart continues from the last committed batch.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.semantics import count_true, ratio
from ..session import fresh_path

# fixed values: weekly alarm limits
MIN_RECALL, MAX_FALSE_ALARM = 0.75, 0.003


def event_stream(spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """File stream over the matching Parquet files of a folder; the schema comes from a footer, not from a scan. A backlog is taken in batches of files."""
    schema = spark.read.option("pathGlobFilter", glob).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a bounded stream into a Parquet table and return it."""
    spark = stream.sparkSession
    out, state = fresh_path(spark, f"{name}-out"), fresh_path(spark, f"{name}-state")
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_to_partials(stream: DataFrame, name: str, partial, path: str | None = None) -> DataFrame:
    """Run a bounded stream and write ``partial(batch)`` of each batch under its number; returns all of them.

    Partial sums can be added up in any order, so rows never come too late: the result is the same for any order and number of files. No state is kept, a batch that is repeated after a failure
    replaces itself, and a later run with the same ``path`` goes on after the last committed batch.
    """
    spark = stream.sparkSession
    path = path or fresh_path(spark, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{path}/out/part={batch_id}")

    stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/out").drop("part")


def flag(scored: DataFrame, threshold_e4: int) -> DataFrame:
    """Frozen-threshold decision per row; stateless, so it works on streams and tables alike."""
    return scored.withColumn("flagged", F.col("score_e4") >= threshold_e4)


WEEK_COUNTS = ("tp", "fn", "fp", "tn")


def week_counts(flagged: DataFrame) -> DataFrame:
    """Confusion counts of each seven-day window of a batch."""
    one, hit = F.col("label") == 1, F.col("flagged")
    g = flagged.groupBy(F.window("ts", "7 days")).agg(*(count_true(c).alias(n) for n, c in zip(WEEK_COUNTS, (one & hit, one & ~hit, ~one & hit, ~one & ~hit))))
    return g.select(F.col("window.start").alias("week_start"), *WEEK_COUNTS)


def weekly_monitor(flagged: DataFrame, path: str | None = None) -> DataFrame:
    """Recall, false-alarm rate and breach per seven-day window of a stream."""
    g = run_to_partials(flagged, "weekly", week_counts, path).groupBy("week_start").agg(*(F.sum(c).alias(c) for c in WEEK_COUNTS))
    recall, alarm = ratio("tp", F.col("tp") + F.col("fn"), 0.0), ratio("fp", F.col("fp") + F.col("tn"), 0.0)
    return g.select("week_start", *WEEK_COUNTS, recall.alias("recall"), alarm.alias("false_alarm"), ((recall < MIN_RECALL) | (alarm > MAX_FALSE_ALARM)).alias("breach"))


def daily_sum(events: DataFrame, path: str | None = None) -> DataFrame:
    """Sum and number of events of each day of a stream."""
    def day(batch: DataFrame) -> DataFrame:
        return batch.groupBy(F.window("ts", "1 day")).agg(F.sum("value").alias("value"), F.count("*").alias("n")).select(F.col("window.start").alias("day"), "value", "n")
    return run_to_partials(events, "days", day, path).groupBy("day").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))


def sliding_sum(days: DataFrame, width: int = 30) -> DataFrame:
    """Sums over ``width`` days, sliding by one day, from the latest day sums, so that an event is not copied into every window."""
    wide = days.groupBy(F.window("day", f"{width} days", "1 day")).agg(F.sum("value").alias("total"), F.sum("n").alias("events"))
    return wide.select(F.col("window.end").alias("window_end"), "total", "events")


class CustomerDays(StatefulProcessor):
    """State of a customer: first and last day, value on the first day and on all others, and one bit for each day between.

    Whatever the order of the rows, these say the number of active days and their totals exactly, so nothing has to be kept open for late rows.
    """

    def __init__(self, idle_ms: int = 0):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        shape = "first long, last long, first_total double, rest double, days binary"
        self.state = handle.getValueState("customer", shape, self.idle_ms) if self.idle_ms else handle.getValueState("customer", shape)

    def handleInputRows(self, key, rows, timer_values):
        day = pd.concat(rows).groupby("day")["value"].sum()
        first, last, first_total, rest, days = self.state.get() if self.state.exists() else (int(day.index.min()), int(day.index.min()), 0.0, 0.0, b"")
        bits = int.from_bytes(days, "little")  # bit 0 is the first day
        for d, value in day.items():
            d = int(d)
            if d < first:
                bits, rest, first, first_total = bits << first - d, rest + first_total, d, 0.0
            bits |= 1 << d - first
            last = max(last, d)
            if d == first:
                first_total += float(value)
            else:
                rest += float(value)
        self.state.update((first, last, first_total, rest, bits.to_bytes(-(-bits.bit_length() // 8), "little")))
        yield pd.DataFrame({"user_id": [key[0]], "last": [last]})

    def close(self) -> None:
        pass


def _day_values(batches):
    """Values of each (customer, day) of a batch of rows, so that a busy customer is few rows."""
    for pdf in batches:
        yield pdf.groupby(["user_id", "day"], as_index=False)["value"].sum()


def customer_state(events: DataFrame, path: str | None = None, idle_ms: int = 0) -> DataFrame:
    """Running customer summary of a stream of (user_id, ts, value), read from the state store after the run.

    The state is one row a customer, a bit a day; with ``idle_ms`` customers without rows for that time leave it. A later run with the same ``path`` goes on from the committed state.
    """
    spark = events.sparkSession
    path = path or fresh_path(spark, "customers")
    provider, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(provider)
    days = events.filter("user_id IS NOT NULL AND ts IS NOT NULL").select("user_id", F.datediff(F.to_date("ts"), F.lit("1970-01-01")).cast("long").alias("day"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"))
    kind = events.schema["user_id"].dataType.simpleString()
    days = days.mapInPandas(_day_values, f"user_id {kind}, day long, value double")
    spark.conf.set(provider, rocks)
    try:
        out = days.groupBy("user_id").transformWithStateInPandas(CustomerDays(idle_ms), f"user_id {kind}, last long", "Update", "ProcessingTime" if idle_ms else "None")
        out.writeStream.format("noop").outputMode("update").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(provider, before)
    kept = spark.read.format("statestore").option("stateVarName", "customer").load(f"{path}/state")
    value = F.col("value.value") if idle_ms else F.col("value")
    kept = kept.select(F.col("key.user_id").alias("user_id"), value.alias("c"))
    day = lambda c: F.date_add(F.lit("1970-01-01").cast("date"), F.col(c).cast("int"))
    # ones in the hexadecimal form of the bits
    ones = F.aggregate(F.split(F.hex("c.days"), ""), F.lit(0), lambda a, h: a + F.when(h == "", 0).otherwise(F.bit_count(F.conv(h, 16, 10).cast("int"))))
    per = kept.select("user_id", day("c.first").alias("first_day"), day("c.last").alias("last_day"), (ones - 1).cast("long").alias("frequency"), F.col("c.rest").alias("rest"))
    return per.select("user_id", "first_day", "last_day", "frequency", F.date_diff("last_day", "first_day").alias("recency"), ratio("rest", "frequency", 0.0).alias("monetary_value"))


def deduplicated(events: DataFrame, key: str = "event_id", delay_days: int = 2, path: str | None = None) -> DataFrame:
    """First copy of every transaction of a stream with a time ``ts``; copies may be up to ``delay_days`` apart, their files in any order.

    What is kept is written by day, and a batch is compared with the days around its own rows only, early or late ones alike. Rows without a key are all kept.
    """
    spark = events.sparkSession
    path = path or fresh_path(spark, "unique")
    schema = T.StructType([*events.schema.fields, T.StructField("part", T.LongType()), T.StructField("day", T.DateType())])

    def save(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("day", F.to_date("ts"))
        near = rows.select("day").distinct().select(F.explode(F.sequence(F.date_sub("day", delay_days), F.date_add("day", delay_days))).alias("day")).distinct()
        fresh = rows.filter(F.col(key).isNotNull()).dropDuplicates([key])
        if batch_id:
            days = [r["day"] for r in near.collect()]  # days, not rows
            known = spark.read.schema(schema).option("basePath", f"{path}/out").parquet(f"{path}/out").filter(F.col("day").isin(days) & (F.col("part") != batch_id)).select(key)
            fresh = fresh.join(known, key, "left_anti").select(*rows.columns)
        fresh.unionByName(rows.filter(F.col(key).isNull())).write.mode("overwrite").partitionBy("day").parquet(f"{path}/out/part={batch_id}")

    events.writeStream.foreachBatch(save).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/out").select(*events.columns)


def answered(questions: DataFrame, answer, key: str = "id", path: str | None = None) -> DataFrame:
    """Answers of a stream of questions, one for each id: a batch answers what no earlier batch has answered and is written under its number.

    A batch that is repeated after a crash replaces itself, and a later run with the same ``path`` answers only what is new. Questions without an id are left out.
    """
    spark = questions.sparkSession
    path = path or fresh_path(spark, "answers")
    schema = answer(spark.createDataFrame([], questions.schema)).schema

    def save(batch: DataFrame, batch_id: int) -> None:
        new = batch.filter(F.col(key).isNotNull()).dropDuplicates([key])
        if batch_id:
            known = spark.read.schema(T.StructType([*schema.fields, T.StructField("part", T.LongType())])).parquet(f"{path}/out").filter(F.col("part") < batch_id)
            new = new.join(known.select(key), key, "left_anti").select(*batch.columns)
        answer(new).write.mode("overwrite").parquet(f"{path}/out/part={batch_id}")

    questions.writeStream.foreachBatch(save).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/out")
