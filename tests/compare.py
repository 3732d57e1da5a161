"""Run queries against their SQL on the same tables: python tests/compare.py [folder] [names...]"""

import glob
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, table):
    """Sorted rows as text, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in table)


def differences(df, con, sql):
    """Empty when equal, else a short description."""
    start = time.time()
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}", took, len(got)
    if len(got) != len(want):
        return f"{len(got)} rows but SQL has {len(want)}", took, len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    off = [(x, y) for x, y in zip(a, b) if x != y]
    if off:
        short = tuple(str(x)[:300] for x in off[0])
        return f"{len(off)} rows differ, e.g. {short[0]} / {short[1]}", took, len(got)
    return "", took, len(got)


def main():
    from heatline.session import build_session
    import __spark_entry__ as entry
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session("compare", f"local[{os.environ.get('COMPARE_CPUS', '8')}]", 8, **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), entry.oracle_sql(), 0
    for name in names:
        try:
            start = time.time()
            df = entry.queries()[name](spark, folder)
            if name in sql:
                text, _, n = differences(df, con, sql[name])
            else:
                text, n = "", df.count()
            state = "ok" if not text else "DIFF"
            kind = "sql" if name in sql else "rows"
            print(f"{state:5}{kind:5}{name:32}{n:8} rows {time.time() - start:6.2f}s  {text}", flush=True)
            bad += bool(text)
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: {str(e)[:600]}", flush=True)
    print(f"{bad} bad of {len(names)}")


if __name__ == "__main__":
    main()
