"""Rows of a query and of its SQL, made comparable."""

import os

import duckdb
import numpy as np
import pandas as pd


def views(folder):
    db = duckdb.connect()
    for name in os.listdir(folder):
        path = f"{folder}/{name}"
        db.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return db


def value(x):
    if x is None or x is pd.NA or x is pd.NaT or isinstance(x, float) and np.isnan(x):
        return None
    if isinstance(x, (float, np.floating)):
        return round(float(x), 7)
    return x.item() if isinstance(x, np.generic) else x


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(value, r)) for r in frame.itertuples(index=False)), key=repr)
