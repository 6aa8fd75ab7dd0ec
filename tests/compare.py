"""Compare Spark results with an independent engine's, regardless of row order."""

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(r[i] for i in order) for r in data), key=repr)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(db, sql):
    cursor = db.execute(sql)
    return rows([c[0] for c in cursor.description], cursor.fetchall())
