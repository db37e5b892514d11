"""Compare a query's rows with those of its SQL, in any order, floats to nine digits."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/*.parquet'" if os.path.isdir(path) else f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "asDict"):
        return tuple(map(plain, v))
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(spark, connection, build, sql, sf_dir):
    made = build(spark, sf_dir)
    told = connection.execute(sql)
    names = [d[0] for d in told.description]
    assert sorted(made.columns) == sorted(names)
    assert rows_of(made.columns, made.collect()) == rows_of(names, told.fetchall())
