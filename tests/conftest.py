import os
import sys
import tempfile
from collections import Counter
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "3g")
        .config("spark.local.dir", folder)
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.warehouse.dir", folder + "/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def same(spark, query, sql, sf=SF):
    """Holds a query against SQL on the same tables, rows in any order."""
    import duckdb

    con = duckdb.connect()
    con.execute("SET timezone='UTC'")
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    frame = query(spark, sf)
    columns = sorted(frame.columns)
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({sql})")
    assert sorted(d[0] for d in want.description) == columns
    got, want = Counter(map(tuple, frame.select(*columns).collect())), Counter(want.fetchall())
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
