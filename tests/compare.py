"""Runs queries next to their SQL counterparts and compares the values.

    python tests/compare.py [--sf DIR] [name ...]
"""

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if v is None or v != v:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(v + 0.0) if v else "0.0"
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in rows)


def difference(df, con, sql):
    """None when equal, else a short text."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    got = df.collect()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    a, b = _rows(df.columns, got), _rows(names, expected)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--zone", default="UTC", help="time zone of the Spark session")
    args = parser.parse_args()

    import __spark_entry__ as entry
    from mensura.session import local_session

    spark, con = local_session(), duck(args.sf)
    spark.conf.set("spark.sql.session.timeZone", args.zone)
    queries, sqls = entry.queries(), entry.oracle_sql()
    unknown = set(sqls) - set(queries)
    failed = len(unknown)
    if unknown:
        print("SQL without query:", unknown)
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in sqls:
                verdict = difference(df, con, sqls[name])
                shown = "ok" if verdict is None else f"DIFFERS {verdict}"
                failed += verdict is not None
                if verdict is None and not con.execute(f"SELECT 1 FROM ({sqls[name]}) LIMIT 1").fetchall():
                    shown = "ok (no rows)"
            else:
                shown = f"rows only: {df.count()}"
        except Exception as exc:  # noqa: BLE001
            failed += 1
            shown = f"ERROR {str(exc)[:600]}"
        print(f"{name:32s} {time.time() - start:6.2f}s {shown}", flush=True)
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
