"""Run registered queries against their SQL: python tests/check_oracles.py [folder] [name part ...]"""
import math, os, sys, time
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import duckdb
import __spark_entry__ as entry
from venuelens.session import build_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def norm(v):
    if v is None: return (0, "")
    if isinstance(v, bool): return (1, str(v))
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        f = float(v)
        return (2, "nan" if math.isnan(f) else repr(f))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def unwanted(df, name):
    """Plan nodes that must not appear: all-pairs joins, and Python outside HTML parsing."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    nodes = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsIn"]
    if not name.startswith("R13"):
        nodes.append("MapInPandas")
    return [n for n in nodes if n in plan]


def compare(spark, con, name, folder):
    df = entry.queries()[name](spark, folder)
    if unwanted(df, name):
        return 0, False, f"plan has {unwanted(df, name)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got), None, ""
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = rows_of(cols, cur.fetchall())
    if sorted(cols) != sorted(df.columns):
        return len(got), False, f"columns {df.columns} vs {cols}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return len(got), False, f"rows {len(got)} vs {len(want)}; spark {only_got}; sql {only_want}"
    return len(got), True, ""


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": "/tmp/vl-warehouse"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in entry.queries():
        if parts and not any(p in name for p in parts): continue
        t = time.time()
        try:
            n, ok, why = compare(spark, con, name, folder)
        except Exception as e:
            n, ok, why = 0, False, f"{type(e).__name__} {str(e)[:600]}"
        bad += ok is False
        print(f"{'ok  ' if ok else 'rows' if ok is None else 'FAIL'} {name} {n} {time.time()-t:.2f}s {why}", flush=True)
    print("failed:", bad)
