"""Every query of the library against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import canon

from garimpo import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    if name in SQL:
        a, b = canon(got), canon(duck.execute(SQL[name]).df())
        assert list(a.columns) == list(b.columns)
        assert a.equals(b)
    else:
        assert len(got.columns) > 0


def test_names_are_in_both_maps():
    assert set(SQL) <= set(registry.queries())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_landing_leaves_the_classifier_usable(spark, sf_dir):
    q = registry.queries()
    assert q["raw_landing"](spark, sf_dir).count() > 0
    assert q["classify_docs"](spark, sf_dir).filter("prediction in (0, 1)").count() == q["classify_docs"](spark, sf_dir).count()
