"""Queries that run a bounded stream to its end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.operators.scratch import shared_folder
from tessera.sources.tables import table
from tessera.streaming import loops

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


def events(spark, d):
    """The events table as a stream of files, under the schema of the table."""
    rows = table(spark, d, "events")
    return loops.source(spark, f"{d}/events.parquet*", rows.schema).withColumn("ts", F.col("ts").cast("timestamp"))


def events_twice(spark, d):
    """The events with every third a second time."""
    rows = events(spark, d)
    return rows.withColumn("_copy", F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_copy")


@query("select user_id, event_type, count(*) as moments from (select distinct user_id, event_type, ts from events) e group by 1, 2")
def stream_dedup(spark, d):
    kept = loops.distinct_within(events_twice(spark, d).select("user_id", "event_type", "ts"), ["user_id", "event_type", "ts"], "ts", "3650 days")
    rows = loops.run_to_end(kept, _folder(spark))
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("moments"))


@query()
def stream_price_state(spark, d):
    steps = events(spark, d).select(F.col("event_type").alias("part"), "event_id", F.col("value").alias("minutes"), (F.col("user_id") % 3 == 0).cast("double").alias("units"))
    out = loops.price_state(steps, "part", "event_id", "minutes", "units")
    folder = _folder(spark)
    done = out.writeStream.outputMode("update").foreachBatch(lambda frame, k: frame.write.mode("append").parquet(f"{folder}/rows")).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    done.awaitTermination()
    rows = spark.read.schema(out.schema).parquet(f"{folder}/rows")
    return rows.groupBy("part").agg(F.max_by(F.struct("price", "dry"), "seen").alias("s"), F.max("seen").alias("seen")).select("part", F.round("s.price", 6).alias("price"), F.round("s.dry", 6).alias("dry"), "seen")


@query("select user_id as root, least(count(*), 5) as kept from events group by 1")
def stream_lineage_cap(spark, d):
    rows = loops.run_to_end(loops.lineage_cap(events(spark, d).select("user_id", "event_id"), "user_id", "event_id", 5), _folder(spark))
    return rows.groupBy("root").agg(F.count("*").alias("kept"))
