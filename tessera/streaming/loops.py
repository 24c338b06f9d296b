"""Micro-batch loops: deduplication across batches, price and debt state, lineage caps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.operators.supply import CAP, EMA


def run_to_end(frame: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Write what a bounded stream has now, and read it; ``folder`` must be one that all executors share."""
    done = frame.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/state").outputMode(mode).trigger(availableNow=True).start()
    done.awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{folder}/rows")


def source(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def distinct_within(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """First arrival of each key; the watermark bounds what is remembered."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def price_state(stream: DataFrame, part: str, order: str, minutes: str, units: str) -> DataFrame:
    """Per partition the exponential means of minutes and units and their ratio, after each micro-batch; minutes since
    the last unit count up to a cap."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spent, found, dry, seen = state.get if state.exists else (0.0, 0.0, 0.0, 0)
        for row in pd.concat(list(batches)).sort_values(order).itertuples():
            m, u = float(getattr(row, minutes)), float(getattr(row, units))
            dry = 0.0 if u > 0 else min(CAP, dry + m)
            spent, found = (m, u) if not seen else (spent * (1 - EMA) + m * EMA, found * (1 - EMA) + u * EMA)
            seen += 1
        state.update((spent, found, dry, seen))
        yield pd.DataFrame({"part": [key[0]], "price": [spent / max(found, 1e-9)], "dry": [dry], "seen": [seen]})

    kind = "spent double, found double, dry double, seen long"
    return stream.groupBy(part).applyInPandasWithState(step, "part string, price double, dry double, seen long", kind, "update", GroupStateTimeout.NoTimeout)


def lineage_cap(stream: DataFrame, root: str, order: str, cap: int) -> DataFrame:
    """Rows of a root until it has ``cap`` of them, over all batches; later ones are closed out."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        taken = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(order)
        keep = rows.head(max(0, cap - taken))
        state.update((taken + len(keep),))
        yield pd.DataFrame({"root": [key[0]] * len(keep), "id": keep[order].tolist()})

    return stream.groupBy(root).applyInPandasWithState(step, "root long, id long", "taken long", "append", GroupStateTimeout.NoTimeout)


def floor_debt(steps: pd.DataFrame, floor: float, trigger: float) -> pd.DataFrame:
    """Minutes a partition is owed: it accrues the floor's share of each batch less what it got, and is due once the
    debt passes ``trigger`` mean batches. One row per batch and partition, a handful."""
    out, debt = [], {p: 0.0 for p in steps["part"].unique()}
    for k, (batch, rows) in enumerate(steps.groupby("batch"), 1):
        total = rows["minutes"].sum()
        got = rows.groupby("part")["minutes"].sum()
        mean = steps[steps["batch"] <= batch]["minutes"].sum() / k
        for part in debt:
            debt[part] = max(0.0, debt[part] + floor * total - float(got.get(part, 0.0)))
            out.append((batch, part, debt[part], debt[part] >= trigger * mean))
    return pd.DataFrame(out, columns=["batch", "part", "debt", "due"])
