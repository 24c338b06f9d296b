import json

import numpy as np
import pytest
from pyspark.sql import types as T

from tessera.sources import stores

ROW = T.StructType([T.StructField(n, t) for n, t in (("schema", T.IntegerType()), ("kind", T.StringType()), ("batch", T.StringType()), ("id", T.LongType()), ("score", T.IntegerType()))])


def write(path, rows, tail=""):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows) + tail)
    return str(path)


def test_ledger_skips_a_torn_tail(spark, tmp_path):
    rows = [{"schema": 1, "kind": "a", "id": 1}, "", {"schema": 1, "kind": "b", "id": 2, "more": 3}]
    path = write(tmp_path / "x.jsonl", rows, '{"schema": 1, "kind": "a", "i')
    assert [(r.kind, r.id) for r in stores.ledger(spark, path, ROW).orderBy("id").collect()] == [("a", 1), ("b", 2)]
    assert stores.ledger(spark, path, ROW, kind="b").count() == 1
    with pytest.raises(Exception, match="not a row"):
        stores.strict_ledger(spark, path, ROW).collect()


def test_malformed_and_other_versions_raise(spark, tmp_path):
    with pytest.raises(Exception, match="not a row"):
        stores.ledger(spark, write(tmp_path / "a.jsonl", ['{"schema": 1, kind}', {"schema": 1}]), ROW).collect()
    with pytest.raises(Exception, match="schema 2"):
        stores.ledger(spark, write(tmp_path / "b.jsonl", [{"schema": 2}]), ROW).collect()
    with pytest.raises(Exception, match="schema missing"):
        stores.ledger(spark, write(tmp_path / "c.jsonl", [{"kind": "a"}]), ROW).collect()


def test_labels_number_their_lines_and_registry_takes_the_last(spark, tmp_path):
    (tmp_path / "rows").mkdir()
    write(tmp_path / "rows/a.jsonl", [{"schema": 1, "batch": "x", "id": 1}, {"schema": 1, "batch": "y", "id": 2}])
    write(tmp_path / "rows/b.jsonl", [{"schema": 1, "batch": "x", "id": 3}])
    got = stores.labels(spark, str(tmp_path / "rows"), ROW).collect()
    assert {(r._file, r._line, r.id) for r in got} == {("a.jsonl", 1, 1), ("a.jsonl", 2, 2), ("b.jsonl", 1, 3)}
    assert {(r.batch, r.id) for r in stores.registry(spark, str(tmp_path / "rows"), ROW).collect()} == {("x", 3), ("y", 2)}


def test_append_checks_first(spark, tmp_path):
    known = spark.createDataFrame([("x",)], "batch string")
    make = lambda *rows: spark.createDataFrame(rows, "batch string, id long, score int")
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="one batch"):
        stores.append(make(("x", 1, 1), ("y", 2, 2)), out, known)
    with pytest.raises(ValueError, match="registered"):
        stores.append(make(("y", 1, 1)), out, known)
    with pytest.raises(ValueError, match="1 to 4"):
        stores.append(make(("x", 1, 9)), out, known)
    stores.append(make(("x", 1, None), ("x", 2, 4)), out, known)
    stores.append(make(("x", 3, 1)), out, known)
    assert stores.ledger(spark, out, ROW).count() == 3


def test_decisions_keep_other_partitions(spark, tmp_path):
    make = lambda *rows: spark.createDataFrame(rows, "key string, verdict string, stage string, run string, partition string")
    path = str(tmp_path / "d")
    stores.write_decisions(make(("b", "v", "s", "r1", "p"), ("a", "v", "s", "r1", "p"), ("c", "v", "s", "r2", "p")), path)
    stores.write_decisions(make(("z", "w", "s", "r2", "p")), path)
    assert [(r.key, r.verdict) for r in stores.read_decisions(spark, path, "s").collect()] == [("a", "v"), ("b", "v"), ("z", "w")]
    assert [r.key for r in stores.read_decisions(spark, path, "s", "r1").collect()] == ["a", "b"]


def test_mismatches_prefix_copies(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "i long, v string")
    b = spark.createDataFrame([(1, "x"), (2, "q"), (4, "z")], "i long, v string")
    assert {r.i for r in stores.mismatches(a, b, "i").collect()} == {2, 3, 4}
    m = spark.createDataFrame([(1, "p"), (2, "q"), (3, "p"), (4, "r")], "i long, k string")
    assert {r.i for r in stores.prefix(m, "i", "k", 2).collect()} == {1, 2, 3}
    f = lambda *rows: spark.createDataFrame(rows, "path string, size long, sha string")
    got = stores.verified_copy(f(("a", 1, "s"), ("b", 1, "s"), ("c", 1, "s")), f(("a", 1, "s"), ("b", 2, "t"), ("d", 1, "s")))
    assert {(r.path, r.state) for r in got.collect()} == {("b", "changed"), ("c", "missing"), ("d", "extra")}


def test_field_dumps(spark, tmp_path):
    values = np.arange(6, dtype="<f4")
    (tmp_path / "one.f32").write_bytes(values.tobytes())
    (tmp_path / "one.json").write_text(json.dumps({"width": 3, "height": 2}))
    r = stores.fields(spark, str(tmp_path)).first()
    assert (r.name, r.width, r.height, list(r["values"])) == ("one", 3, 2, values.tolist())
