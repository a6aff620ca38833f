"""Run registered queries next to their SQL: ``python tests/compare.py [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, bool):
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if v.isoformat().endswith("T00:00:00") else v.isoformat()
    return repr(v) if isinstance(v, (list, tuple)) else v


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> str | None:
    df = fn(spark, sf_dir)
    got_cols, got = _bag(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_cols, want = _bag([c[0] for c in rel.description], rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, missing = list((got - want).items())[:3], list((want - got).items())[:3]
        return f"rows {sum(got.values())} vs {sum(want.values())}; {sum((got - want).values())} differ\n   spark {extra}\n   sql   {missing}"
    types = {t.name: t.dataType.simpleString() for t in df.schema}
    floats = {c: t for c, t in types.items() if t.startswith("decimal")}
    return f"decimal columns {floats}" if floats else None


def main(argv):
    from panelkit.plans import ORACLES, QUERIES
    from panelkit.session import local_session

    sf_dir = argv[0] if argv and argv[0].startswith("/") else "/root/testdata/sf0.01"
    wanted = [a for a in argv if not a.startswith("/")]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, fn in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, fn, ORACLES[name], sf_dir)
                note = "ok"
            else:
                rows = fn(spark, sf_dir).collect()
                problem, note = None, f"rows-only {len(rows)} {[tuple(r) for r in rows[:2]]}"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.1f}s {problem or note}", flush=True)
    print("failed", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
