"""Compare a Spark result with DuckDB over the same Parquet tables."""

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    out = {}
    for name in frame.columns:
        col = frame[name]
        if str(col.dtype).startswith("datetime"):
            col = col.astype("datetime64[us]")
        out[name] = col.map(lambda v: "<null>" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v))
    text = pd.DataFrame(out)
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def compare(spark_df, con, sql) -> str | None:
    result = con.sql(sql).arrow()
    result = result.read_all() if hasattr(result, "read_all") else result
    want = result.to_pandas(integer_object_nulls=True)
    got = spark_df.toArrow().to_pandas(integer_object_nulls=True)
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = normal(got), normal(want)
    for name in a.columns:
        if not a[name].equals(b[name]):
            at = (a[name] != b[name]).idxmax()
            return f"column {name}: {a.loc[at].to_dict()} != {b.loc[at].to_dict()}"
    return None
