import duckdb
import pytest

from deltafolio.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def flat(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(name, spark, sf_dir, duck):
    df = catalogue.queries()[name](spark, sf_dir)
    rows = df.collect()
    sql = catalogue.oracle_sql().get(name)
    if sql:
        cursor = duck.execute(sql)
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert flat(rows, df.columns) == flat(cursor.fetchall(), columns)
