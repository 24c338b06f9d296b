"""JSON-lines stores, partitioned decisions and raster dumps."""

from __future__ import annotations

import json

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: the only version of a row that readers accept.
SCHEMA = 1


def _parsed(lines: DataFrame, schema: T.StructType, torn: bool) -> DataFrame:
    """Rows of JSON ``value`` lines. Blank lines are skipped, and so is a line that doesn't parse and doesn't end in a
    brace, the tail of an interrupted append, if ``torn`` allows it; any other such line, or a row of another schema
    version, is an error when the rows are read."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = lines.where(F.trim("value") != "").withColumn("_row", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("_row").isNull() | F.col("_row._bad").isNotNull()
    if torn:
        rows = rows.where(~(bad & ~F.rtrim("value").endswith("}")))
    version = F.col("_row.schema")
    checked = F.when(bad, F.raise_error(F.concat(F.lit("not a row: "), F.substring("value", 1, 80)))).when(F.coalesce(version != SCHEMA, F.lit(True)), F.raise_error(F.concat(F.lit("schema "), F.coalesce(version.cast("string"), F.lit("missing"))))).otherwise(F.col("_row"))
    rest = [c for c in lines.columns if c != "value"]
    return rows.select(checked.alias("_row"), *rest).select(*[F.col(f"_row.{f.name}").alias(f.name) for f in schema.fields], *rest)


def ledger(spark: SparkSession, paths: list[str] | str, schema: T.StructType, kind: str | None = None, where: Column | None = None) -> DataFrame:
    """Rows of append-only ledgers, of one ``kind`` and under a predicate if given; files split, so order isn't kept."""
    rows = _parsed(spark.read.text(paths), schema, torn=True)
    if kind is not None:
        rows = rows.where(F.col("kind") == kind)
    return rows if where is None else rows.where(where)


def strict_ledger(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _parsed(spark.read.text(path), schema, torn=False)


def labels(spark: SparkSession, paths: list[str] | str, schema: T.StructType) -> DataFrame:
    """Rows with ``_file`` and ``_line``, which later resolution orders by. A store of verdicts is a file per batch, read
    whole to number its lines."""
    return lines(spark, paths, schema)


def registry(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last registration of each batch."""
    rows = labels(spark, path, schema)
    whole = F.struct(*[c for c in rows.columns if not c.startswith("_")])
    return rows.groupBy("batch").agg(F.max_by(whole, F.struct("_file", "_line")).alias("r")).select("r.*")


def append(rows: DataFrame, path: str, known: DataFrame) -> None:
    """Append label rows, all checked before the first is written: exactly one batch, and a registered one."""
    batches = [r[0] for r in rows.select("batch").distinct().limit(2).collect()]
    if len(batches) != 1:
        raise ValueError(f"one batch per append, not {len(batches)}")
    if not known.where(F.col("batch") == batches[0]).limit(1).count():
        raise ValueError(f"batch {batches[0]!r} isn't registered")
    wrong = rows.where(F.col("score").isNotNull() & ~F.col("score").between(1, 4)).limit(1).count()
    if wrong:
        raise ValueError("a score is outside 1 to 4")
    rows.withColumn("schema", F.lit(SCHEMA)).write.mode("append").json(path)


def write_decisions(rows: DataFrame, path: str) -> None:
    """Overwrite the partitions that ``rows`` have, no others."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("stage", "run", "partition").parquet(path)


def read_decisions(spark: SparkSession, path: str, stage: str | None = None, run: str | None = None) -> DataFrame:
    """Decisions in key order; only the folders of the stage and run named are listed."""
    rows = spark.read.parquet(path)
    for column, value in (("stage", stage), ("run", run)):
        if value is not None:
            rows = rows.where(F.col(column) == value)
    return rows.orderBy("key")


def mismatches(ours: DataFrame, theirs: DataFrame, place: str) -> DataFrame:
    """Places at which two ordered tables differ, nulls equal to nulls; a place one lacks is a difference too."""
    a = ours.select(place, F.struct(*ours.columns).alias("ours"))
    b = theirs.select(place, F.struct(*ours.columns).alias("theirs"))
    return a.join(b, place, "full").where(~F.col("ours").eqNullSafe(F.col("theirs")))


def prefix(manifest: DataFrame, order: str, key: str, n: int) -> DataFrame:
    """Rows of the first ``n`` distinct keys of an ordered manifest."""
    firsts = manifest.groupBy(key).agg(F.min(order).alias("_first")).orderBy("_first").limit(n).select(key)
    return manifest.join(firsts, key, "left_semi")


def fields(spark: SparkSession, folder: str) -> DataFrame:
    """Raster dumps, ``<name>.f32`` with a ``<name>.json`` record beside it, as ``(name, width, height, values)``."""
    name = F.regexp_extract("path", r"([^/]+)\.(?:f32|json)$", 1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{f32,json}").load(folder).select(name.alias("name"), F.col("path").endswith(".f32").alias("raster"), "content")

    @F.pandas_udf(T.StructType.fromDDL("width int, height int, values array<float>"))
    def decode(content, record):
        import pandas as pd

        out = []
        for raw, text in zip(content, record, strict=True):
            about = json.loads(text)
            values = np.frombuffer(raw, "<f4")
            if values.size != about["width"] * about["height"]:
                raise ValueError(f"{values.size} values for {about['width']} x {about['height']}")
            out.append((about["width"], about["height"], values))
        return pd.DataFrame(out, columns=["width", "height", "values"])

    rasters = files.where("raster").select("name", "content")
    records = files.where("not raster").select("name", F.col("content").cast("string").alias("record"))
    return rasters.join(records, "name").select("name", decode("content", "record").alias("f")).select("name", "f.*")


def verified_copy(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Files ``(path, size, sha)`` that a copy lacks, has besides, or has with other bytes."""
    both = source.select("path", F.struct("size", "sha").alias("a")).join(copy.select("path", F.struct("size", "sha").alias("b")), "path", "full")
    state = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").when(F.col("a") != F.col("b"), "changed")
    return both.select("path", state.alias("state")).where("state is not null")


def discovered(spark: SparkSession, folders: dict[str, str], name: str = "walk.jsonl", without: str | None = None) -> list[str]:
    """Paths of all files ``name`` below some storage tiers, in the order of their names within a tier: first-writer-wins
    depends on it, and it must not depend on where a tier lies. One path may be left out."""
    found = []
    for tier, root in folders.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root).select("path")
        for (path,) in files.collect():  # a name per ledger
            at = path.find(root.removeprefix("file://").rstrip("/") + "/")
            inner = path[at + len(root.removeprefix("file://").rstrip("/")) + 1 :]
            if path != without and inner != without:
                found.append((inner, tier, path))
    return [path for _, _, path in sorted(found)]


def lines(spark: SparkSession, paths: list[str] | str, schema: T.StructType, torn: bool = False) -> DataFrame:
    """Rows of small stores in written order, ``_file`` and ``_line`` beside them."""
    whole = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_name").alias("_file"), F.posexplode(F.split("value", "\n")).alias("_line", "value"))
    return _parsed(whole.withColumn("_line", F.col("_line") + 1), schema, torn=torn)


def one_row(rows: DataFrame) -> DataFrame:
    """``rows`` if it is a single one; else an error."""
    some = rows.limit(2).collect()
    if len(some) != 1:
        raise ValueError(f"one row wanted, found {'none' if not some else 'more'}")
    return rows.sparkSession.createDataFrame(some, rows.schema)


def last_of(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key, as a sidecar that is appended to is read."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(key).agg(F.max_by(whole, F.struct(*order)).alias("_r")).select("_r.*")


def pool(rows: DataFrame, part: str, least: float) -> DataFrame:
    """Seeds ``(id, part, x, y)``; an error where two of a partition are closer than ``least``."""
    from tessera.operators.joins import closest_pair

    close = closest_pair(rows.select("id", part, "x", "y"), part).select(part, F.when(F.col("distance") < least, F.raise_error(F.concat(F.lit("seeds too close: "), F.col("distance").cast("string")))).otherwise(F.lit(True)).alias("_apart"))
    return rows.join(F.broadcast(close), part).where("_apart").drop("_apart")  # a row per partition


def projected(rows: DataFrame, columns: list[str], path: str, old: str, new: str) -> DataFrame:
    """A manifest's few columns, its paths moved from one storage tier to another."""
    from tessera.functions.places import rehomed

    return rows.select(*[rehomed(F.col(path), old, new).alias(path) if c == path else c for c in columns])


def write_lines(rows: DataFrame, path: str, order: list[str] | None = None, mode: str = "overwrite") -> None:
    """JSON lines, in order where one is given: range partitions keep it over files, and nulls stay as nulls."""
    out = rows.orderBy(*order) if order else rows
    out.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode(mode).text(path)


def append_rows(rows: DataFrame, path: str, kind: str) -> None:
    """Append to a ledger, each row stamped with the schema version and its kind."""
    write_lines(rows.select(F.lit(SCHEMA).alias("schema"), F.lit(kind).alias("kind"), *[c for c in rows.columns if c not in ("schema", "kind")]), path, mode="append")


def upsert_decisions(rows: DataFrame, path: str, carried: str = "rejected") -> None:
    """Merge one run's rows by key into its folder of partitions. A row replaces the one of its key, whichever partition
    that was in, but keeps its ``carried`` value where it has none; partitions left without rows go.

    The merged rows are written beside the folder first, so a lost job leaves the old ones."""
    from tessera.operators.scratch import Scratch, is_empty

    spark = rows.sparkSession
    scratch = Scratch(spark, "decisions")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(hadoop):
        old = spark.read.schema(rows.schema).parquet(path)
        before = old.select("key", F.col(carried).alias("_before"))
        new = rows.join(before, "key", "left").withColumn(carried, F.coalesce(carried, "_before")).select(*rows.columns)
        rows = old.join(rows.select("key"), "key", "left_anti").select(*rows.columns).unionByName(new)
    merged = scratch.keep(rows)
    if is_empty(merged):
        return
    # All partitions are overwritten: those without rows are gone.
    merged.repartition("partition").sortWithinPartitions("key").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("partition").parquet(path)


def write_fields(rasters: DataFrame, folder: str) -> int:
    """Raster dumps of ``(name, width, height, values)``: little-endian 32-bit floats, and a record beside them. Two of one
    name are an error, found before anything is written. Gives the number written."""
    twice = rasters.groupBy("name").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two dumps are named {twice[0]['name']!r}")
    folder = folder.rstrip("/")

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                values = np.asarray(r.values, "<f4")
                if values.size != r.width * r.height:
                    raise ValueError(f"{values.size} values for {r.width} x {r.height}")
                out.append((r.name, values.tobytes(), json.dumps({"width": int(r.width), "height": int(r.height), "dtype": "f32le"})))
            yield pd.DataFrame(out, columns=["name", "raw", "record"])

    # Spark has no sink for one file a row: a table keeps the bytes and the records, which readers and copies agree on.
    packed = rasters.mapInPandas(run, "name string, raw binary, record string")
    packed.write.mode("errorifexists").parquet(folder)
    return rasters.sparkSession.read.parquet(folder).count()


def packed_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Dumps that ``write_fields`` wrote, as ``(name, width, height, values)``."""

    @F.pandas_udf("array<float>")
    def decode(raw):
        return raw.map(lambda b: np.frombuffer(b, "<f4"))

    about = F.from_json("record", "width int, height int")
    return spark.read.parquet(folder).select("name", about.alias("a"), decode("raw").alias("values")).select("name", "a.width", "a.height", "values")


def completed(rows: DataFrame, key: str) -> DataFrame:
    """Attempts a log has, the last of each, and what is left to do with an anti-join on it."""
    return last_of(rows, key, ["_file", "_line"])


def repaired(spark: SparkSession, path: str, out: str) -> int:
    """Rewrite a log without lines that don't parse, so that the next append starts on a line of its own. Gives how many
    lines went."""
    text = spark.read.text(path).where(F.trim("value") != "")
    good = F.from_json("value", "map<string,string>").isNotNull() & F.rtrim("value").endswith("}")
    kept = text.where(good)
    kept.write.mode("overwrite").text(out)
    return text.where(~good).count()


def colour_maps(rows: DataFrame) -> DataFrame:
    """Colour maps ``(name, stops)``; one of fewer than two stops is an error."""
    few = F.size("stops") < 2
    return rows.withColumn("stops", F.when(~few, F.col("stops")).otherwise(F.raise_error(F.concat(F.lit("fewer than two stops: "), F.col("name"))).cast(rows.schema["stops"].dataType)))
