"""Order-free comparison of a Spark query with its SQL."""

import math
import sys
from collections import Counter
from pathlib import Path

try:
    import duckdb
except ImportError:
    sys.path.append("/opt/oracle")
    import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            db.execute(f"create view {table} as select * from read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, db, sql):
    """What only Spark has and what only SQL has; both empty when they agree."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    expected = _bag(names, result.fetchall())
    actual = _bag(frame.columns, [tuple(r) for r in frame.collect()])
    return list((actual - expected).items())[:3], list((expected - actual).items())[:3], sum(actual.values())
