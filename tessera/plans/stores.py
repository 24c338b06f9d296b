"""Queries that write a store, read it back through its reader, and report what came back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.scratch import Scratch
from tessera.sources import stores as S
from tessera.sources.tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def schema(text: str) -> T.StructType:
    return T.StructType.fromDDL("schema int, " + text)


def folder(spark, label: str) -> str:
    """A place for one store, gone with the process that made it."""
    return f"{Scratch(spark, label).root}"


def ledger_rows(spark, d) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select(F.lit(1).alias("schema"), F.when(k % 4 == 0, "batch").otherwise("candidate").alias("kind"), k.alias("id"), F.col("o_custkey").alias("root"), F.col("o_orderstatus").alias("fate"), F.when(k % 6 != 0, k % 101 / 100).alias("score"))


_ROW = "kind string, id long, root long, fate string, score double"


def written(spark, rows: DataFrame, label: str, tail: str | None = None) -> str:
    path = folder(spark, label)
    lines = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    lines.write.text(path)
    if tail is not None:
        spark.createDataFrame([(tail,), ("",)], "value string").coalesce(1).write.mode("append").text(path)
    return path


@query("select kind, count(*) as n, count(score) as scored, sum(id)::bigint as ids from (select case when o_orderkey % 4 = 0 then 'batch' else 'candidate' end as kind, o_orderkey as id, case when o_orderkey % 6 <> 0 then 1 end as score from orders) o group by 1")
def ledger_scan(spark, d):
    path = written(spark, ledger_rows(spark, d), "ledger", '{"schema": 1, "kind": "candidate", "id": 99')
    return S.ledger(spark, path, schema(_ROW)).groupBy("kind").agg(F.count("*").alias("n"), F.count("score").alias("scored"), F.sum("id").alias("ids"))


@query("select o_orderkey as id, o_custkey as root, (o_orderkey % 101) / 100.0::double as score from orders where o_orderkey % 4 <> 0 and o_orderkey % 6 <> 0 and (o_orderkey % 101) / 100.0 >= 0.385 and o_orderstatus = 'F'")
def admitted_scan(spark, d):
    path = written(spark, ledger_rows(spark, d), "admitted")
    return S.ledger(spark, path, schema(_ROW), kind="candidate", where=(F.col("fate") == "F") & (F.col("score") >= 0.385)).select("id", "root", "score")


@query("select count(*) as n, count(distinct o_custkey) as roots, sum(o_orderkey)::bigint as ids from orders")
def strict_ledger_scan(spark, d):
    return S.strict_ledger(spark, written(spark, ledger_rows(spark, d), "strict"), schema(_ROW)).agg(F.count("*").alias("n"), F.count_distinct("root").alias("roots"), F.sum("id").alias("ids"))


@query("select 'tier' || t as tier, 'run' || lpad(r::varchar, 2, '0') as run, (row_number() over (order by r, t))::integer as place from range(2) a(t), range(4) b(r) where not (r = 2 and t = 1)")
def ledger_discovery(spark, d):
    root = folder(spark, "tiers")
    one = table(spark, d, "region").select(F.lit("{}").alias("value")).limit(1)
    tiers = {f"tier{t}": f"{root}/tier{t}" for t in range(2)}
    for t in range(2):
        for r in range(4):
            # Two names to the run: only one of them is a ledger.
            for name in ("walk.jsonl", "other.jsonl"):
                target = f"{root}/tier{t}/run{r:02}/{name}"
                one.coalesce(1).write.text(target + ".d")
                _rename_part(spark, target)
    found = S.discovered(spark, tiers)
    found = [p for p in found if not p.endswith("tier1/run02/walk.jsonl")]
    rows = [(p.split("/")[-3], p.split("/")[-2], i + 1) for i, p in enumerate(found)]
    return spark.createDataFrame(rows, "tier string, run string, place int")


def _rename_part(spark, target: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    part = [s.getPath() for s in files.listStatus(path(target + ".d")) if s.getPath().getName().startswith("part-")][0]
    files.rename(part, path(target))
    files.delete(path(target + ".d"), True)


@query("select event_type as batch, max_by(event_id, event_id) as id, count(*) - 1 as replaced from events group by 1")
def sidecar_scan(spark, d):
    rows = table(spark, d, "events").select(F.lit(1).alias("schema"), F.col("event_type").alias("batch"), F.col("event_id").alias("id"), "value")
    path = folder(spark, "sidecar")
    S.write_lines(rows, path, ["id"])
    got = S.lines(spark, path, schema("batch string, id long, value double"))
    n = got.groupBy("batch").agg((F.count("*") - 1).alias("replaced"))
    return S.last_of(got, "batch", ["id"]).select("batch", "id").join(n, "batch")


@query("select s_nationkey as part, count(*) as n from supplier where s_suppkey % 2 = 0 group by 1")
def label_store(spark, d):
    rows = table(spark, d, "supplier").select(F.col("s_nationkey").alias("batch"), F.col("s_suppkey").alias("id"), F.lit(3).alias("score"), F.concat(F.lit("b"), (F.col("s_suppkey") % 2).cast("string")).alias("file"))
    path = folder(spark, "labels")
    S.write_lines(rows.select(F.lit(1).alias("schema"), "batch", "id", "score", "file"), path, ["id"])
    got = S.labels(spark, path, schema("batch int, id long, score int, file string"))
    return got.where("file = 'b0' and _line > 0").groupBy(F.col("batch").alias("part")).agg(F.count("*").alias("n"))


@query("select c_custkey as key, case when c_custkey % 3 = 0 then 'new' else 'old' end as verdict, case when c_custkey % 5 = 0 then 'over' end as rejected, 'p' || case when c_custkey % 3 = 0 then c_custkey % 2 else c_custkey % 4 end as partition from customer")
def decision_upsert(spark, d):
    c = F.col("c_custkey")
    rows = table(spark, d, "customer")
    path = folder(spark, "decisions")
    old = rows.select(c.alias("key"), F.lit("old").alias("verdict"), F.when(c % 5 == 0, "over").alias("rejected"), F.concat(F.lit("p"), (c % 4).cast("string")).alias("partition"))
    new = rows.where(c % 3 == 0).select(c.alias("key"), F.lit("new").alias("verdict"), F.lit(None).cast("string").alias("rejected"), F.concat(F.lit("p"), (c % 2).cast("string")).alias("partition"))
    S.upsert_decisions(old, path)
    S.upsert_decisions(new, path)
    return spark.read.schema(old.schema).parquet(path)


@query("select n_regionkey as partition, count(*) as n, min(n_name) as first from nation where n_regionkey <> 3 group by 1")
def decision_scan(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_name").alias("key"), F.lit("s").alias("stage"), F.when(F.col("n_regionkey") == 3, "r2").otherwise("r1").alias("run"), F.col("n_regionkey").alias("partition"))
    path = folder(spark, "decided")
    S.write_decisions(rows, path)
    return S.read_decisions(spark, path, "s", "r1").groupBy("partition").agg(F.count("*").alias("n"), F.min("key").alias("first"))


@query("select l_orderkey as location_id, count(*) as tiles, min(l_linenumber) as first from lineitem where l_orderkey in (select distinct l_orderkey from lineitem order by l_orderkey limit 40) group by 1")
def manifest_prefix(spark, d):
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("location_id"), "l_linenumber")
    return S.prefix(rows, "location_id", "location_id", 40).groupBy("location_id").agg(F.count("*").alias("tiles"), F.min("l_linenumber").alias("first"))


@query("select l_orderkey, l_linenumber, case when l_linenumber % 2 = 0 then '/cold/tiles/' || l_orderkey else 'hot/' || l_orderkey end as path from lineitem")
def manifest_projection(spark, d):
    l = table(spark, d, "lineitem")
    path = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("/data/tiles/"), "l_orderkey")).otherwise(F.concat(F.lit("hot/"), "l_orderkey"))
    return S.projected(l.withColumn("path", path), ["l_orderkey", "l_linenumber", "path"], "path", "/data", "/cold")


@query("select s_nationkey as part, count(*) as n from supplier group by 1")
def seed_pools(spark, d):
    s = table(spark, d, "supplier").select(F.lit(1).alias("schema"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("part"), (F.col("s_suppkey") * 0.05).alias("x"), (F.col("s_suppkey") % 3 * 0.05).alias("y"))
    path = folder(spark, "pool")
    S.write_lines(s, path, ["id"])
    return S.pool(S.strict_ledger(spark, path, schema("id long, part int, x double, y double")), "part", 0.032).groupBy("part").agg(F.count("*").alias("n"))


@query("select o_custkey as id, list(o_orderkey order by o_orderkey) as candidates, count(*) as n from orders group by 1")
def candidate_sets(spark, d):
    rows = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.sort_array(F.collect_list("o_orderkey")).alias("candidates")).withColumn("schema", F.lit(1))
    path = folder(spark, "sets")
    S.write_lines(rows.select("schema", "id", "candidates"), path, ["id"])
    return S.strict_ledger(spark, path, schema("id long, candidates array<long>")).select("id", "candidates", F.size("candidates").cast("long").alias("n"))


@query("select n_name as name, n_regionkey + 2 as stops, 0.0::double as low, 1.0::double as high from nation")
def colour_map_scan(spark, d):
    n = F.col("n_regionkey") + 2
    stops = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((i / (n - 1)).alias("pos"), F.array(i * 9, F.lit(7), i).alias("rgb")))
    rows = table(spark, d, "nation").select(F.lit(1).alias("schema"), F.col("n_name").alias("name"), stops.alias("stops"))
    path = folder(spark, "maps")
    S.write_lines(rows, path, ["name"])
    got = S.colour_maps(S.strict_ledger(spark, path, schema("name string, stops array<struct<pos: double, rgb: array<int>>>")))
    return got.select("name", F.size("stops").alias("stops"), F.col("stops")[0]["pos"].alias("low"), F.element_at("stops", -1)["pos"].alias("high"))


@query("select p_brand as name, 4 as width, 2 as height, (sum(p_size) * 8)::double as total from part group by 1")
def field_dumps(spark, d):
    p = table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.sum("p_size").cast("float").alias("s"))
    rows = p.select("name", F.lit(4).alias("width"), F.lit(2).alias("height"), F.array_repeat("s", 8).alias("values"))
    path = folder(spark, "fields")
    S.write_fields(rows, path)
    return S.packed_fields(spark, path).select("name", "width", "height", F.aggregate("values", F.lit(0.0), lambda a, v: a + v).alias("total"))


@query("select 'batch' as kind, count(*) as n from nation union all select 'node', count(*) from region")
def ledger_append(spark, d):
    path = folder(spark, "append")
    S.append_rows(table(spark, d, "nation").select(F.col("n_nationkey").alias("id")), path, "batch")
    S.append_rows(table(spark, d, "region").select(F.col("r_regionkey").alias("id")), path, "node")
    return S.ledger(spark, path, schema("kind string, id long")).groupBy("kind").agg(F.count("*").alias("n"))


@query("select c_nationkey as batch, count(*) as n from customer where c_nationkey < 3 group by 1")
def label_append(spark, d):
    path = folder(spark, "verdicts")
    known = table(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("batch"))
    rows = table(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("batch"), F.col("c_custkey").alias("id"), (1 + F.col("c_custkey") % 4).cast("int").alias("score"))
    for batch in range(3):
        one = rows.where(F.col("batch") == batch)
        if one.limit(1).count():
            S.append(one, path, known)
    return S.ledger(spark, path, schema("batch long, id long, score int")).groupBy("batch").agg(F.count("*").alias("n"))


@query("select o_orderkey as attempt from orders where o_orderkey % 7 = 0")
def log_repair(spark, d):
    """Attempts that a log with a torn tail doesn't have."""
    o = table(spark, d, "orders").select(F.lit(1).alias("schema"), F.col("o_orderkey").alias("attempt"))
    path = written(spark, o.where("attempt % 7 <> 0"), "log", '{"schema": 1, "attem')
    out = folder(spark, "repaired")
    assert S.repaired(spark, path, out) == 1
    done = S.completed(S.lines(spark, out, schema("attempt long")), "attempt")
    return o.select("attempt").join(done.select("attempt"), "attempt", "left_anti")


@query("select n_nationkey as id, n_name as name, n_regionkey = 1 as eval from nation where n_regionkey = 1")
def split_write(spark, d):
    """The evaluation side of a split, written in order and read back."""
    n = table(spark, d, "nation").select(F.lit(1).alias("schema"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), (F.col("n_regionkey") == 1).alias("eval"))
    path = folder(spark, "split")
    S.write_lines(n.where("eval"), path, ["id"])
    return S.strict_ledger(spark, path, schema("id int, name string, eval boolean")).drop("schema")


@query("select s_suppkey as id, case when s_suppkey % 9 = 0 then 'lost' when s_suppkey % 10 = 0 then 'changed' end as state from supplier where s_suppkey % 9 = 0 or s_suppkey % 10 = 0")
def plan_compare(spark, d):
    """Rows of a written plan that a new one lacks or has otherwise."""
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_name", "s_acctbal")
    path = folder(spark, "plan")
    S.write_lines(rows.withColumn("schema", F.lit(1)).select("schema", "id", "s_name", "s_acctbal"), path, ["id"])
    old = S.strict_ledger(spark, path, schema("id long, s_name string, s_acctbal double")).drop("schema")
    new = rows.where("id % 9 <> 0").withColumn("s_acctbal", F.when(F.col("id") % 10 == 0, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")))
    return S.mismatches(old, new, "id").select("id", F.when(F.col("theirs").isNull(), "lost").otherwise("changed").alias("state"))


@query("select o_orderstatus as path, case o_orderstatus when 'F' then 'missing' when 'P' then 'changed' end as state from orders where o_orderstatus in ('F', 'P') group by 1")
def copy_verify(spark, d):
    f = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("path")).agg(F.count("*").alias("size"), F.md5(F.sum("o_orderkey").cast("string")).alias("sha"))
    copy = f.where("path <> 'F'").withColumn("sha", F.when(F.col("path") == "P", "x").otherwise(F.col("sha")))
    return S.verified_copy(f, copy)


@query("select r_regionkey as id, r_name as name from region where r_regionkey = 2")
def single_record(spark, d):
    rows = table(spark, d, "region").where("r_regionkey = 2").select(F.lit(1).alias("schema"), F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    path = folder(spark, "single")
    S.write_lines(rows, path)
    return S.one_row(S.strict_ledger(spark, path, schema("id int, name string"))).drop("schema")

