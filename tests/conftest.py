import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemart.session import session

    root = tmp_path_factory.mktemp("spark")
    s = session(
        "tests", f"local[{os.environ.get('TEST_CPUS', '4')}]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="3g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{root}/shared", spark__sql__warehouse__dir=f"{root}/warehouse",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def rows_of(df) -> list[tuple]:
    """Rows with columns by name, sorted: what two results are compared by."""
    names = sorted(df.columns)
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=order)


def plain(v):
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def order(row):
    return tuple((v is None, str(v)) for v in row)


def same_as_sql(df, duck, sql: str) -> None:
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    at = [names.index(n) for n in sorted(names)]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=order)
    assert rows_of(df) == want
