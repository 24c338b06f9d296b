"""Written tables in the folder that the whole cluster shares, and sides small enough to send to all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.scratch import Scratch as Tables
from tessera.operators.scratch import is_empty, partitions, shared_folder

__all__ = ["Scratch", "free", "is_empty", "partitions", "shared_folder", "small", "small_batches"]

#: Numbers in a table that is sent to all executors at most: some 20 MB.
SMALL = 500_000


#: Rows of texts that go to a Python worker at once, at most: both sides hold a batch.
BATCH = 1024


def small_batches(spark) -> None:
    """Keep batches of texts small in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:
        spark.conf.set(name, BATCH)


class Scratch(Tables):
    """Written tables of one run; batches of texts stay small while it works."""

    def __init__(self, spark, label: str):
        super().__init__(spark, label)
        small_batches(spark)
        # Shuffles of whatever ran before go now.
        self.settle()


def free(frame: DataFrame, name: str) -> str:
    """A column name made from ``name`` that ``frame`` doesn't have, in whatever case."""
    taken = {c.lower() for c in frame.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name += "_"
    return name


def small(frame: DataFrame, size=None) -> DataFrame:
    """``frame`` marked for broadcast if it was counted to hold SMALL numbers at most; else as it is, to be shuffled.

    ``size`` counts the numbers of a row, one by default. ``frame`` should be a kept table: it is read to count it.
    """
    n = frame.agg(F.sum(F.lit(1) if size is None else size)).first()[0] or 0
    return F.broadcast(frame) if n <= SMALL else frame
