"""Run every registered query in Spark and its oracle in DuckDB; compare.

    python tools/oracle_check.py [sf_dir] [name-substring ...]

Compares row count, column names and an order-insensitive hash of values
(columns sorted by name), printing one line per query.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from mobility.plans.registry import REGISTRY  # noqa: E402
from mobility.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


# DuckDB type names as Spark's simple type strings.
DUCK_TO_SPARK = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def duck_types(con, sql: str) -> dict[str, str]:
    rel = con.sql(sql)
    return {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}


def _canon(v):
    if v is None or (not isinstance(v, (list, tuple, dict)) and pd.isna(v)):
        return None
    if hasattr(v, "isoformat"):
        # dates and timestamps compare as text; a midnight timestamp and a
        # date of the same day are one value here
        return v.isoformat().replace("T00:00:00", "").replace("T", " ")
    if hasattr(v, "item"):
        return v.item()
    return v


def frame_hash(pdf: pd.DataFrame) -> str:
    pdf = pdf[sorted(pdf.columns)]
    rows = sorted(repr(tuple(_canon(v) for v in r)) for r in pdf.itertuples(index=False))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()[:12]


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    spark = local_session("oracle-check")
    bad = 0
    for q in REGISTRY:
        if wanted and not any(w in q.name for w in wanted):
            continue
        t0 = time.time()
        sdf = q.build(spark, sf_dir)
        stypes = dict(sdf.dtypes)
        spd = sdf.toPandas()
        dt = time.time() - t0
        if q.sql is None:
            print(f"{q.name:45s} rows={len(spd):6d} (no oracle) {dt:.2f}s")
            continue
        dpd = con.execute(q.sql).df()
        same_cols = sorted(spd.columns) == sorted(dpd.columns)
        same_types = stypes == duck_types(con, q.sql)
        hs, hd = frame_hash(spd), frame_hash(dpd) if same_cols else "-"
        ok = same_cols and same_types and len(spd) == len(dpd) and hs == hd
        bad += not ok
        print(f"{q.name:45s} rows={len(spd):6d}/{len(dpd):6d} cols={'ok' if same_cols else 'DIFF'} "
              f"types={'ok' if same_types else 'DIFF'} hash={'ok' if hs == hd else 'DIFF'} "
              f"{'PASS' if ok else 'FAIL'} {dt:.2f}s")
        if not ok:
            print("   spark:", list(spd.columns), spd.dtypes.tolist())
            print("   duck :", list(dpd.columns), dpd.dtypes.tolist())
            print(spd.sort_values(list(spd.columns)).head(3).to_string())
            print(dpd.sort_values(list(dpd.columns)).head(3).to_string())
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
