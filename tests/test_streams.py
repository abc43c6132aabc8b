"""Streams of records with many keys, cascades, failures by record and messages delivered again."""

import json
import random

import pytest
from pyspark.sql import functions as F

from garimpo.operators import keys
from garimpo.streaming import keys as stream_keys
from garimpo.streaming import records, stages


def send(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / f"{name}.json").write_text("".join(json.dumps({"entity": e, "id": i, "body": json.dumps(b)}) + "\n" for e, i, b in rows))


def stream(spark, path, per_batch=1):
    return spark.readStream.schema(records.MESSAGE).option("maxFilesPerTrigger", per_batch).json(str(path))


DEPS = [keys.Dependency("line", "order", "order_no", "no", True), keys.Dependency("line", "part", "part.code", "code"), keys.Dependency("order", "client", "client", "id")]


def run(spark, at, deps=DEPS, parts=4):
    records.run(stream(spark, at / "in"), deps, str(at / "out"), str(at / "check"), parts)
    return {(r.entity, r.id): r for r in records.read_out(spark, str(at / "out")).collect()}


def test_records_with_several_keys_and_a_restart(spark, tmp_path):
    line = lambda i, order, part: ("line", f"l{i}", {"order_no": order, "part": {"code": part}, "q": i})
    send(tmp_path / "in", "1", [line(1, 7, "x"), line(2, 7, None), line(3, None, "x"), line(4, 8, "y"), line(5, 0, "")])
    got = run(spark, tmp_path)
    assert set(got) == set()
    # The order comes, but its client has not; part x is there at once.
    send(tmp_path / "in", "2", [("order", "o7", {"no": 7, "client": "c1"}), ("part", "p", {"code": "x", "name": "bolt"}), ("order", "o0", {"no": 0}), line(1, 7, "x")])
    got = run(spark, tmp_path)
    assert set(got) == {("part", "p"), ("order", "o0"), ("line", "l5")}  # 0 is a value, an empty key is none
    send(tmp_path / "in", "3", [("client", "c", {"id": "c1"}), ("order", "late", {"no": 7, "client": "c1"})])
    got = run(spark, tmp_path)
    assert set(got) == {("part", "p"), ("order", "o0"), ("line", "l5"), ("client", "c"), ("order", "o7"), ("order", "late"), ("line", "l1"), ("line", "l2")}
    assert json.loads(got["line", "l1"].body)["q"] == 1 and json.loads(got["line", "l1"].found["part.code"])["name"] == "bolt"
    assert json.loads(got["line", "l1"].found["order_no"])["client"] == "c1" and set(got["line", "l2"].found) == {"order_no"}
    # What comes again is not resolved again.
    send(tmp_path / "in", "4", [line(1, 7, "x"), ("client", "c", {"id": "c1"})])
    assert len(run(spark, tmp_path)) == records.read_out(spark, str(tmp_path / "out")).count() == 8


def test_records_wait_in_joins_and_not_in_python(spark, tmp_path):
    """A call of Python for each key made the stream fail by time (F10, F12); only a time limit needs it."""
    (tmp_path / "in").mkdir()
    back = spark.readStream.schema(records.RESOLVED).parquet(str(tmp_path / "in"))
    plan = lambda **more: records.resolve(stream(spark, tmp_path / "in"), back, DEPS, **more)._jdf.queryExecution().logical().toString()
    assert "TransformWithState" not in plan() and plan().count("Join Inner") == 2  # a line has two keys at most
    assert plan(ttl_ms=1000).count("TransformWithState") == 2


def test_a_late_record_meets_the_first_of_two_references_and_none_without_keys_waits(spark, tmp_path):
    send(tmp_path / "in", "1", [("part", "p1", {"code": "x", "name": "first"}), ("line", "none", {"order_no": None, "part": {"code": "x"}})])
    assert set(run(spark, tmp_path)) == {("part", "p1")}
    send(tmp_path / "in", "2", [("part", "p0", {"code": "x", "name": "second"}), ("other", "o", {})])
    assert set(run(spark, tmp_path)) == {("part", "p1"), ("part", "p0"), ("other", "o")}
    send(tmp_path / "in", "3", [("order", "o7", {"no": 7}), ("line", "l", {"order_no": 7, "part": {"code": "x"}})])
    got = run(spark, tmp_path)
    assert json.loads(got["line", "l"].found["part.code"])["name"] == "first" and len(got) == 5


def test_chains_of_thirty_over_five_batches_equal_the_closure(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    rng = random.Random(4)
    nodes = [("n", f"{c}-{i}", {"key": f"{c}-{i}", "needs": f"{c}-{i - 1}" if i else None}) for c in range(3) for i in range(30)]
    nodes += [("n", "x", {"key": "x", "needs": "y"}), ("n", "y", {"key": "y", "needs": "x"}), ("n", "z", {"key": "z", "needs": "nowhere"})]
    rng.shuffle(nodes)
    for b in range(5):
        send(tmp_path / "in", str(b), nodes[b::5])
    try:
        got = run(spark, tmp_path, [keys.Dependency("n", "n", "needs", "key")], 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    df = spark.createDataFrame([(i, b["needs"]) for _, i, b in nodes], "id string, ref string")
    want = {r.id for r in keys.closure(df.select("id"), df).collect()}
    assert {i for _, i in got} == want and len(want) == 90


# Stages ----------------------------------------------------------------------------------


def lines(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / f"{name}.txt").write_text("".join((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in rows))


def outputs(spark, at):
    return {x: stages.read_out(spark, str(at / "out"), x).collect() for x in stages.OUTPUTS}


def stage_run(spark, at, stage, schema="id string", **more):
    stages.run(stages.messages(spark, str(at / "in")), schema, stage, str(at / "out"), str(at / "check"), **more)
    return outputs(spark, at)


def test_one_bad_message_leaves_the_others(spark, tmp_path):
    lines(tmp_path / "in", "1", [{"id": "1"}, {"id": "2"}, {"id": "bad"}, {"id": "4"}, "no json"])
    got = stage_run(spark, tmp_path, stages.Stage(lambda df: df.withColumn("n", F.col("id").cast("int") * 2)))
    assert sorted(r.n for r in got["published"]) == [2, 4, 8]
    (bad,) = got["failed"]
    assert json.loads(bad.original_message) == {"id": "bad"} and "CAST_INVALID_INPUT" in bad.error and bad.error_type and "Traceback" in bad.stack_trace
    assert [r.original_message for r in got["unparsable"]] == ["no json"]


def test_many_bad_messages_of_user_code(spark, tmp_path):
    lines(tmp_path / "in", "1", [{"id": str(i)} for i in range(60)])

    def fails(batches):
        for pdf in batches:
            if (pdf.id.astype(int) % 20 == 7).any():
                raise KeyError("seven")
            yield pdf

    got = stage_run(spark, tmp_path, stages.Stage(lambda df: df.mapInPandas(fails, df.schema)))
    assert sorted(int(r.id) for r in got["published"]) == [i for i in range(60) if i % 20 != 7]
    assert sorted(json.loads(r.original_message)["id"] for r in got["failed"]) == ["27", "47", "7"] and all("seven" in r.error for r in got["failed"])


def test_storage_errors_stop_the_stream(spark, tmp_path):
    lines(tmp_path / "in", "1", [{"id": "1"}])
    broken = [True]

    def process(df):
        if not broken[0]:
            return df

        def lost(batches):
            raise OSError("disk gone")
            yield

        return df.mapInPandas(lost, df.schema)

    with pytest.raises(Exception, match="disk gone"):
        stages.run(stages.messages(spark, str(tmp_path / "in")), "id string", stages.Stage(process), str(tmp_path / "out"), str(tmp_path / "check"))
    broken[0] = False  # the batch was not lost
    got = stage_run(spark, tmp_path, stages.Stage(process))
    assert [r.id for r in got["published"]] == ["1"] and got["failed"] == []


def test_a_stage_broken_for_every_message_stops(spark, tmp_path):
    rows = spark.createDataFrame([(str(i), "x") for i in range(40)], "id string, original_message string")

    def publish(part, k):
        part.select(F.raise_error(F.lit("always")).alias("x")).collect()

    parts = stages.Bisection(rows, publish, most=6)
    with pytest.raises(RuntimeError, match="too many"):
        parts.run()


def test_records_by_user_code(spark, tmp_path):
    lines(tmp_path / "in", "1", [{"id": "1"}, {"id": "x"}, {"id": "3"}, {"id": "0"}])

    def double(r):
        return None if r["id"] == "0" else {"n": int(r["id"]) * 2}  # a null result is not published

    got = stage_run(spark, tmp_path, stages.Stage(stages.per_record(double, "n long")))
    assert sorted(r.n for r in got["published"]) == [2, 6]
    (bad,) = got["failed"]
    assert bad.error_type == "ValueError" and "invalid literal" in bad.error and json.loads(bad.original_message) == {"id": "x"}


def test_a_message_delivered_again_is_published_once(spark, tmp_path):
    same = {"raw_data_id": "a", "id": "1"}
    lines(tmp_path / "in", "1", [same, {"raw_data_id": "b", "id": "2"}, {"id": "no name"}])
    got = stage_run(spark, tmp_path, stages.Stage(lambda df: df))
    lines(tmp_path / "in", "2", [same, same, {"raw_data_id": "c", "id": "3"}, {"id": "no name"}])
    got = stage_run(spark, tmp_path, stages.Stage(lambda df: df))  # a new run of the stream
    assert sorted(r.id for r in got["published"]) == ["1", "2", "3", "no name", "no name"]
    lines(tmp_path / "in", "3", [same])
    assert len(stage_run(spark, tmp_path, stages.Stage(lambda df: df))["published"]) == 5


def test_children_wait_for_the_first_parent_without_python_state(spark, tmp_path):
    schema = "row_id string, fk string, is_parent boolean, body string"
    batches = [
        [("a", "1", False, "x"), ("b", "2", False, "y"), ("n", None, False, "z")],
        [("p", "1", True, "first"), ("m", None, True, "none")],
        [("q", "1", True, "second"), ("c", "1", False, "w"), ("d", "3", False, "v")],
    ]
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:  # a run each, with the same checkpoint
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        assert "Pandas" not in stream_keys.resolve(stream)._jdf.queryExecution().analyzed().toString()
        stream_keys.run(stream, out, str(tmp_path / "at"))
    got = sorted((r.child_id, r.fk, r.child, r.parent) for r in spark.read.schema(stream_keys.OUT).parquet(out).collect())
    assert got == [("a", "1", "x", "first"), ("c", "1", "w", "first")]


def test_a_file_written_by_one_task_is_computed_by_all(spark):
    from garimpo.plans import flow

    assert "Coalesce" not in flow.one_file(spark.range(10).groupBy("id").count())._jdf.queryExecution().executedPlan().toString()
    assert flow.one_file(spark.range(10)).rdd.getNumPartitions() == 1
    assert not [f for f in (flow.stream_once, flow.stream_cache) if "coalesce" in f.__code__.co_names]
