"""The keyed store of cached collections, and the cached collector over many batches."""

from pyspark.sql import functions as F

from garimpo.operators import cache
from garimpo.streaming import cache as served
from garimpo.streaming.settings import Store, cover

CONFIG = "config map<string,string>"


def test_runs_cover_all_batches():
    for fan in (2, 3, 8):
        for n in range(200):
            runs = cover(n, fan)
            assert [b for level, start in runs for b in range(start, start + fan**level)] == list(range(n))
            assert len(runs) <= (fan - 1) * 8


def test_store_finds_what_a_scan_finds_and_opens_few_files(spark, tmp_path):
    """Fifty batches: the same answers as over all configs at once, and no more files from batch to batch."""
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    store, all_, files = Store(spark, str(tmp_path / "index"), buckets=4, fan=4), [], []
    asked_schema = f"hash string, {CONFIG}"
    try:
        for batch in range(50):
            rows = [(f"c{batch:03}-{i}", {"portal": f"p{i % 2}", "user": f"u{batch * 3 + i}"} | ({"deep": "3"} if batch % 3 == 0 else {})) for i in range(3)]
            if batch % 7 == 0:
                rows.append((f"c{batch:03}-again", {"portal": "p0", "user": "u0", "deep": "3"}))
            if batch in (1, 20, 49):
                asked = [("a", {"portal": "p0", "user": f"u{batch}"}), ("b", {"user": "u7"}), ("c", {"deep": "3"}), ("d", {}), ("e", {"portal": "p9"}), ("f", {"portal": "p0", "deep": "3", "user": "u0"})]
                asked = spark.createDataFrame(asked, asked_schema)
                want = cache.holding(asked, spark.createDataFrame(all_, f"collect_id string, {CONFIG}"))
                assert sorted(map(tuple, store.holding(asked, batch).collect())) == sorted(map(tuple, want.collect()))
                files.append(len(store._of(batch, spark.createDataFrame([("x",)], "s string")).inputFiles()))
            for _ in range(2 if batch % 8 == 7 else 1):  # a batch done again changes nothing
                store.add(spark.createDataFrame(rows, f"collect_id string, {CONFIG}"), batch)
            all_ += rows
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert max(files) <= 3 * 3 * 4  # (fan - 1) runs of three levels, four buckets


def test_cached_collector_over_batches(spark, tmp_path):
    batches = [
        [(1, {"a": "1", "b": "2"}), (2, {"b": "2", "a": "1"}), (3, {"a": "9", "use_cache": "false"})],
        [(4, {"a": "1"}), (5, {"a": "1", "b": "2", "no_cache": "true"}), (6, {})],
        [(7, {"b": "2"}), (8, {"c": "1"}), (9, {"a": "9"})],
    ]
    for k, rows in enumerate(batches):
        df = spark.createDataFrame(rows, f"request_id long, {CONFIG}").withColumn("config", F.map_entries("config")).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("request_id long, config array<struct<key:string,value:string>>").parquet(str(tmp_path / "in")).withColumn("config", F.map_from_entries("config"))
        served.serve(stream, str(tmp_path / "out"), str(tmp_path / "check"), lambda c: c.select("collect_id", F.lit("r").alias("raw_data_id")), buckets=4)
    got = {r.request_id: (r.action, r.collect_id) for r in spark.read.parquet(str(tmp_path / "out" / "actions")).collect()}
    assert got == {1: ("miss", None), 2: ("miss", None), 3: ("bypass", None), 4: ("hit", "c1"), 5: ("miss", None), 6: ("hit", "c1"), 7: ("hit", "c1"), 8: ("miss", None), 9: ("miss", None)}
    assert sorted(r.collect_id for r in spark.read.parquet(str(tmp_path / "out" / "configs")).collect()) == ["c1", "c5", "c8", "c9"]
