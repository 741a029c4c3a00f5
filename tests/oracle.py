"""Side-by-side comparison of a Spark query with its DuckDB SQL, as order-insensitive rows."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()[:26]
    if isinstance(value, int):
        return int(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def assert_same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = connect(sf_dir).execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want), (len(got), len(want))
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            same = a == b or (isinstance(a, (int, float)) and isinstance(b, (int, float)) and math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6))
            assert same, (g, w)
    return len(got)
