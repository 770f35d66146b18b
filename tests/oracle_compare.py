"""Compare a Spark query with its SQL counterpart on the same tables."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql):
    """None when equal, else a short description."""
    mine = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    theirs = _sorted_rows(names, relation.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{str(a)[:400]} against {str(b)[:400]}"
    return None
