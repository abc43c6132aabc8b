import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.mkdtemp(prefix="spark-"), "warehouse")).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}{'/*.parquet' if f.is_dir() else ''}'")
    return con
