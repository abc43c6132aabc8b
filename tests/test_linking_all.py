"""The linking queries against SQL that compares all pairs of a municipality, without any index of parts."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from compare import canon

from garimpo import registry
from garimpo.plans.linking import PAIRS

NAMES = ["link_candidates", "link_top3", "candidate_info", "dup_candidates", "disambiguate", "link_news", "apply_links", "stream_link"]


@pytest.mark.parametrize("name", NAMES)
def test_equals_all_pairs(spark, duck, sf_dir, name):
    sql = registry.oracle_sql()[name]
    assert PAIRS in sql
    a = canon(registry.queries()[name](spark, sf_dir).toPandas())
    b = canon(duck.execute(sql.replace(PAIRS, "asked JOIN offered USING (id_municipio)")).df())
    assert list(a.columns) == list(b.columns)
    assert a.equals(b)
