import math
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr([plain(x) for x in v]) if isinstance(v, list) else repr(v)


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir, duck):
    def check(query, sql):
        df = query(spark, sf_dir)
        rel = duck.execute(sql)
        names = [c[0] for c in rel.description]
        want = rel.fetchall()
        assert sorted(df.columns) == sorted(names)
        cols = sorted(names)
        at = [names.index(c) for c in cols]
        got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
        assert got == sorted(tuple(plain(r[i]) for i in at) for r in want)

    return check
