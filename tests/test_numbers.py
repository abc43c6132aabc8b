"""Tender numbers compared within tasks, against all pairs of their scope."""

import random

import pytest
from pyspark.sql import functions as F

from garimpo.operators import linking, numbers


def texts(n, seed):
    rnd = random.Random(seed)
    odd = ["", "/", "é12/2020", "É12/2020", "12/2020 ", "PL 12/2020", "ª١٢/2020", "Σ-1", "x", "a%b/2020", "2/2020", "edital de pregao eletronico numero 12/2020 da secretaria"]
    return odd + [f"{rnd.choice(['', '00', 'PL ', 'edital '])}{rnd.randint(1, 300)}/{rnd.choice((2019, 2020))}" for _ in range(n)]


@pytest.mark.parametrize("cell", [7, 40, 100_000])
@pytest.mark.parametrize("least", [0.2, 0.5])
def test_equals_all_pairs(spark, monkeypatch, cell, least):
    monkeypatch.setattr(numbers, "CELL", cell)
    a = spark.createDataFrame([(i, t, i % 3 if i % 7 else 0) for i, t in enumerate(texts(120, 1))], "a long, text string, s long").withColumn("kind", F.lit(0.5).cast("float"))
    b = spark.createDataFrame([(i, t, i % 3 if i % 5 else 0) for i, t in enumerate(texts(150, 2))], "b long, text string, s long")
    got = numbers.near_or_containing(a, b, least, ["s"]).collect()
    every = a.join(b.withColumnRenamed("text", "text_b"), "s").withColumn("x", linking.similarity(F.col("text"), F.col("text_b")))
    holds = numbers.plain(F.col("text")) & F.expr("text_b ilike concat('%', text, '%')")
    want = every.filter((F.col("x") > F.lit(least).cast("float")) | holds).select("a", "b", "text_b", "kind", "x").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 300


def test_a_text_is_dealt_once_in_a_small_scope(spark):
    a = spark.createDataFrame([(i, f"{i}/2020", 0) for i in range(500)], "a long, text string, s long").withColumn("kind", F.lit(0.0).cast("float"))
    rows = numbers.near_or_containing(a, a.select(F.col("a").alias("b"), "text", "s"), 0.5, ["s"])
    sc = spark.sparkContext._jsc.sc()
    first = sc.dagScheduler().nextStageId()
    assert rows.agg(F.sum("score")).first()[0] > 500
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    sent = []
    for stage in range(first, sc.dagScheduler().nextStageId()):
        try:
            sent.append(sc.statusStore().lastStageAttempt(stage).shuffleWriteRecords())
        except Exception:  # noqa: BLE001  a stage that was not run
            pass
    assert 1000 <= sum(sent) <= 1100
