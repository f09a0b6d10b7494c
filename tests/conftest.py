import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from rankloom.session import get_session

    folder = tmp_path_factory.mktemp("shared")
    session = get_session("tests", "local[4]", 4, **{"spark.checkpoint.dir": f"file://{folder}", "spark.sql.warehouse.dir": str(folder / "warehouse"), "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def plain(value):
    """A value as it compares between engines."""
    if value is None or value != value:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if isinstance(value, float):
        return round(value, 6) + 0.0
    return value


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    """Whether a DataFrame and an SQL text give the same rows, whatever their order."""

    def compare(df, sql):
        got = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
        found = duck.execute(sql)
        names = [d[0] for d in found.description]
        assert sorted(names) == sorted(df.columns)
        order = [names.index(c) for c in sorted(names)]
        want = [tuple(plain(r[i]) for i in order) for r in found.fetchall()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))

    return compare
