"""Run registered queries next to their check SQL and compare the rows.

usage: python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from streamlab import build_session  # noqa: E402
from streamlab.workloads import all_oracles, all_queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def cell(v: object) -> str:
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], str, list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(cell(r[i]) for i in order) for r in rows)
    return [columns[i] for i in order], hashlib.md5("\n".join(lines).encode()).hexdigest(), lines


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    oracles, bad = all_oracles(), 0
    for name, fn in all_queries().items():
        if wanted and name not in wanted:
            continue
        try:
            begun = time.time()
            df = fn(spark, sf)
            got = [tuple(r) for r in df.collect()]
            spent = time.time() - begun
            if name not in oracles:
                print(f"ROWS  {name} rows={len(got)} {spent:.2f}s", flush=True)
                continue
            begun = time.time()
            cur = con.execute(oracles[name])
            exp_cols = [d[0] for d in cur.description]
            exp = cur.fetchall()
            duck = time.time() - begun
            a, b = digest(df.columns, got), digest(exp_cols, exp)
            ok = a[0] == b[0] and a[1] == b[1]
            print(
                f"{'OK  ' if ok else 'DIFF'}  {name} rows={len(got)}/{len(exp)} {spent:.2f}s duck={duck:.2f}s",
                flush=True,
            )
            if not ok:
                bad += 1
                left, right = set(a[2]) - set(b[2]), set(b[2]) - set(a[2])
                print("   cols", a[0], b[0])
                print("   spark only", sorted(left)[:3])
                print("   duck only ", sorted(right)[:3])
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: {str(exc)[:600]}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
