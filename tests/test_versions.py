"""Tables that change together, and submissions from file to governed table."""

import json
import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.plans import intakes
from tidemark.sources import sheets
from tidemark.sources.versions import Conflict, Part, Store
from tidemark.streaming import intake as I
from tidemark.streaming.submissions import AUDIT, GOVERNED, LOADS, STAGED


def rows(store, table, version=None, slices=None):
    return sorted(tuple(r) for r in store.read(table, version, slices).collect())


def frame(spark, *values):
    return spark.createDataFrame(list(values), "d string, k long")


def test_slices_and_appends(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.latest().number == 0 and store.read("t") is None
    one = store.publish([Part("t", frame(spark, ("a", 1), ("b", 2), ("c/ é%", 3)), "d", ("a", "b", "c/ é%")), Part("log", frame(spark, ("x", 1)), append=True)], store.latest(), {"id": 3})
    two = store.publish([Part("t", frame(spark, ("a", 9)), "d", ("a", "b")), Part("log", frame(spark, ("y", 2)), append=True)], one)
    assert rows(store, "t") == [("a", 9), ("c/ é%", 3)] and rows(store, "log") == [("x", 1), ("y", 2)] and rows(store, "t", one) == [("a", 1), ("b", 2), ("c/ é%", 3)]
    assert rows(store, "t", two, ["b"]) == [] and rows(store, "t", two, ["c/ é%"]) == [("c/ é%", 3)] and store.latest() == two and two.counters == {"id": 3}
    # a slice's folder is all that is read of it
    assert len(store.read("t", two, ["a"]).inputFiles()) == 1
    three = store.publish([Part("t", frame(spark, ("z", 0)))], two)
    assert rows(store, "t", three) == [("z", 0)]
    with pytest.raises(ValueError, match="outside"):
        store.publish([Part("t", frame(spark, ("q", 1)), "d", ("a",))], three)
    assert store.latest() == three and len(store.unnamed(3)) == 1


def test_a_writer_that_fails_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    one = store.publish([Part("t", frame(spark, ("a", 1))), Part("u", frame(spark, ("a", 1)))], store.latest())
    broken = frame(spark, ("a", 5)).withColumn("k", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.publish([Part("t", frame(spark, ("b", 2))), Part("u", broken)], one)
    assert store.latest() == one and rows(store, "t") == [("a", 1)] and rows(store, "u") == [("a", 1)]
    assert store.publish([Part("t", frame(spark, ("b", 2)))], one).number == 2


def test_of_two_writers_one_publishes(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    read = store.publish([Part("t", frame(spark, ("a", 0)))], store.latest())
    outcomes = []

    def write(k):
        try:
            Store(spark, str(tmp_path)).publish([Part("t", frame(spark, ("a", k)))], read)
            outcomes.append(k)
        except Conflict:
            outcomes.append(None)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    (won,) = (k for k in outcomes if k is not None)
    assert len(outcomes) == 4 and rows(store, "t") == [("a", won)] and store.numbers() == [1, 2]


def submit(folder, name, rows, **control):
    folder.mkdir(exist_ok=True)
    head = {"template": intakes.TEMPLATE, "version": intakes.VERSION} | control
    records = [{"control": head}, *({"row": dict(zip(intakes.SHEET.columns, r, strict=True))} for r in rows)]
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))


def outcomes(job):
    return {r.file.rsplit("/", 1)[1]: (r.state, r.insert, r.update, r.replace, r.delete) for r in job.store.read(LOADS).collect()}


def test_submissions_from_file_to_governed_table(spark, tmp_path):
    job, folder = intakes.submissions(spark, str(tmp_path)), tmp_path / "in"
    row = lambda code, total, day="2024-01-01", domain="A": (domain, str(code), str(total), day)
    submit(folder, "a1", [row(1, 10), row(2, 20)])
    # the same batch: another domain, a second file of the first one, files that fail at each gate
    submit(folder, "a2", [row(1, 11), row(3, 30, "2024-02-01")], base_load="1")
    submit(folder, "a3", [row(1, 12)], base_load="1")
    submit(folder, "b1", [row(1, 1, domain="B"), row("x", 1, domain="B")])
    submit(folder, "c1", [row(1, 1, domain="C"), row(1, 1, domain="D")])
    submit(folder, "e1", [row(1, 1, domain="E")], version="1.1.0")
    submit(folder, "f1", [row(1, 1, domain="F")], domain="G")
    (folder / "g1").write_text('{"control": {"template": "catalogue", "version": "1.2.0"}}\n{"row": {"domain": "H", "code": "1", "sum": "1"}}')
    (folder / "h1").write_text("no record\n")
    job.start(spark, str(folder), str(tmp_path / "checkpoint"), files_per_batch=50).awaitTermination()
    zero = (0, 0, 0, 0)
    want = {"a1": ("MERGE_OK", 2, 0, 0, 0), "a2": ("MERGE_OK", 1, 1, 0, 1), "a3": ("REJECTED_STALE", *zero), "b1": ("ERROR_STAGING", *zero), "c1": ("REJECTED_DOMAIN", *zero), "e1": ("REJECTED_VERSION", *zero), "f1": ("REJECTED_DOMAIN", *zero), "g1": ("REJECTED_STRUCTURE", *zero), "h1": ("REJECTED_CONTROL", *zero)}
    got = outcomes(job)
    base = {r.file.rsplit("/", 1)[1]: r.id_load for r in job.store.read(LOADS).collect()}
    assert base["a1"] == 1 and got == want
    governed = lambda: sorted((r.id, r.code, r.total, r.version, r.active) for r in job.store.read(GOVERNED).collect())
    assert governed() == [(1, 1, 11, "1", True), (2, 2, 20, "1", False), (3, 3, 30, "1", True)]
    assert sorted(r.code for r in job.store.read(STAGED).collect()) == [1, 3]
    assert sorted((r.code, r.action) for r in job.store.read(AUDIT).collect()) == [(1, "INSERT"), (1, "UPDATE"), (2, "DELETE"), (2, "INSERT"), (3, "INSERT")]
    # the batch again, from its first number: nothing changes
    before, numbers = governed(), job.store.numbers()
    job.start(spark, str(folder), str(tmp_path / "lost"), files_per_batch=50).awaitTermination()
    assert governed() == before and job.store.numbers() == numbers and outcomes(job) == want


def test_a_batch_that_broke_off_goes_on(spark, tmp_path):
    """The second wave fails after the first one is published; the batch is run again."""
    job, folder = intakes.submissions(spark, str(tmp_path)), tmp_path / "in"
    submit(folder, "a1", [("A", "1", "10", "2024-01-01")])
    submit(folder, "a2", [("A", "1", "10", "2024-02-01"), ("A", "2", "5", None)])
    publish, calls = job.store.publish, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("executor lost")
        return publish(*args, **kwargs)

    job.store.publish = failing
    with pytest.raises(Exception, match="executor lost"):
        job.start(spark, str(folder), str(tmp_path / "checkpoint")).awaitTermination()
    assert outcomes(job) == {"a1": ("MERGE_OK", 1, 0, 0, 0)}
    job.start(spark, str(folder), str(tmp_path / "checkpoint")).awaitTermination()
    assert outcomes(job) == {"a1": ("MERGE_OK", 1, 0, 0, 0), "a2": ("MERGE_OK", 1, 0, 1, 0)}
    assert sorted((r.id, r.code, r.version, r.active) for r in job.store.read(GOVERNED).collect()) == [(1, 1, "1", False), (2, 1, "2", True), (3, 2, "1", True)]


def test_contents_of_lines(spark, tmp_path):
    text = "\n".join(f"line {k % 7}" for k in range(5000))
    for name, body in {"one": text, "copy": text, "turned": "\n".join(reversed(text.split("\n"))), "more": text + "\nline 0"}.items():
        (tmp_path / name).write_text(body)
    told = {}
    for size in ("1000b", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        lines = I.line_places(I.lines_of(spark.read.text(str(tmp_path))))
        told[size] = {r.file.rsplit("/", 1)[1]: r.content for r in I.contents(lines, F.col("place"), ["value"]).collect()}
        assert lines.agg(F.count_distinct("file", "place")).first()[0] == 20001
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # whatever the splits: equal files are equal, an order or a line more isn't
    assert told["1000b"] == told["128m"] and told["128m"]["one"] == told["128m"]["copy"] and len(set(told["128m"].values())) == 3


def test_a_cluster_must_name_its_shared_folder():
    for master, fine in (("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("spark://host:7077", False), ("yarn", False)):
        context = SimpleNamespace(master=master, applicationId="none", getConf=lambda: SimpleNamespace(get=lambda k: None))
        spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: "/tmp/warehouse" if "warehouse" in k else None))
        if fine:
            assert sheets.shared_folder(spark)
        else:
            with pytest.raises(ValueError):
                sheets.shared_folder(spark)
