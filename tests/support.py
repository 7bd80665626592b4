"""Running a query's SQL beside it."""

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value.isoformat() if hasattr(value, "isoformat") else value


def rows_of(df) -> list:
    return sorted((tuple(sorted((k, plain(v)) for k, v in r.asDict().items())) for r in df.collect()), key=repr)


def rows_of_sql(con, sql: str) -> list:
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    return sorted((tuple(sorted((k, plain(v)) for k, v in zip(names, r, strict=True))) for r in found.fetchall()), key=repr)
