"""Runs named queries next to their SQL twins and reports differences.

Usage: python tools/check.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from legwork.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def rows_of(frame) -> list[tuple]:
    names = sorted(frame.columns)
    rows = []
    for row in frame[names].itertuples(index=False):
        rows.append(tuple(normal(v) for v in row))
    return sorted(rows, key=repr)


def normal(value):
    if value is None:
        return None
    if hasattr(value, "item") and not isinstance(value, (list, tuple)) and getattr(value, "size", 1) == 1:
        value = value.item()
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0 if value != int(value) or abs(value) > 1e15 else int(value)
    if isinstance(value, bool):
        return int(value)
    if value.__class__.__name__ in ("NaTType", "NAType"):
        return None
    return value


def compare(spark, con, name, entry, sf_dir):
    start = time.time()
    got = entry.run(spark, sf_dir).toPandas()
    took = time.time() - start
    if entry.sql is None:
        return took, len(got), "rows only"
    want = con.execute(entry.sql).fetch_df()
    if sorted(got.columns) != sorted(want.columns):
        return took, len(got), f"COLUMNS {sorted(got.columns)} / {sorted(want.columns)}"
    kinds = [
        f"{c}:{got[c].dtype}/{want[c].dtype}"
        for c in got.columns
        if str(got[c].dtype).rstrip("0123456789").lower() != str(want[c].dtype).rstrip("0123456789").lower()
    ]
    a, b = rows_of(got), rows_of(want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3]
        only_b = [r for r in b if r not in set(a)][:3]
        return took, len(got), f"VALUES {len(a)}/{len(b)} {sorted(got.columns)}\n   spark {only_a}\n   sql   {only_b}"
    return took, len(got), "ok" + (f" (kinds {kinds})" if kinds else "")


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["--sf"]:
        sf_dir, args = args[1], args[2:]
    from legwork.registry import load

    entries = load()
    names = [n for n in entries if not args or n in args or any(a.endswith("*") and n.startswith(a[:-1]) for a in args)]
    spark = local_session(cores="8")
    con = oracle(sf_dir)
    bad = 0
    for name in names:
        try:
            took, rows, verdict = compare(spark, con, name, entries[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            took, rows, verdict = 0.0, -1, f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        if not verdict.startswith(("ok", "rows only")):
            bad += 1
        print(f"{name:28s} {took:7.2f}s {rows:8d} {verdict}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
