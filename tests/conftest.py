import duckdb
import pytest

from snpspark.session import session

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    out = session(8, **{"spark.driver.memory": "6g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    out.sparkContext.setLogLevel("ERROR")
    out.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return out


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def rows_of(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(map(str, pdf[cols].astype(object).where(pdf[cols].notna(), None).values.tolist()))


@pytest.fixture(scope="session")
def agrees(spark, sf, duck):
    """Checks a query against its SQL."""

    def check(query, sql):
        assert rows_of(query(spark, sf).toPandas()) == rows_of(duck.execute(sql).fetchdf())

    return check
