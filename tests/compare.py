"""Run registered queries and their SQL twins side by side.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def ordered(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    names, mine = ordered(df.columns, df.collect())
    if sql is None:
        return True, f"{len(mine)} rows, no SQL"
    found = con.sql(sql)
    theirs_names, theirs = ordered(list(found.columns), found.fetchall())
    if names != theirs_names:
        return False, f"columns {names} / {theirs_names}"
    kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = [(c, kinds.get(t, t)) for c, t in sorted(df.dtypes)]
    if types != sorted(zip(found.columns, map(str, found.types))):
        return False, f"types {types} / {sorted(zip(found.columns, map(str, found.types)))}"
    if len(mine) != len(theirs):
        return False, f"{len(mine)} / {len(theirs)} rows"
    bad = [(a, b) for a, b in zip(mine, theirs)
           if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return not bad, f"{len(mine)} rows" + (f", {len(bad)} differ: {bad[0]}" if bad else "")


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from broadloom.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session(os.environ.get("BROADLOOM_TEST_CORES", "8")), connect(sf_dir)
    spark.sparkContext.setLogLevel("OFF")
    bad = 0
    for name, fn in queries().items():
        if args and name not in args:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, name, fn, oracle_sql().get(name), sf_dir)
        except Exception as e:  # report and go on
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
