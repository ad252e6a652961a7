"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tools/check_oracle.py [sf_dir] [name-substring ...]

Comparison mirrors the driver: row count, column names, and an
order-insensitive multiset of rows (floats compared after the query's own
rounding, with a small tolerance as a second look).
"""

from __future__ import annotations

import math
import sys
import time
import traceback

sys.path.insert(0, ".")

import duckdb  # noqa: E402

from tidewater.plans.catalog import load_all  # noqa: E402
from tidewater.plans.tables import BASE_TABLES  # noqa: E402
from tidewater.session import local_session  # noqa: E402


STRICT = bool(__import__("os").environ.get("STRICT"))


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(tuple(v))
    if v.__class__.__name__ == "Decimal":
        return round(float(v), 9)
    return v


def _coarse(row):
    return repr(tuple(float(f"{v:.4g}") if isinstance(v, float) else v for v in row))


def _close(a, b) -> bool:
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if not math.isclose(x, y, rel_tol=1e-7, abs_tol=1e-9):
                return False
        elif isinstance(x, (int, float)) and isinstance(y, (int, float)) and not isinstance(x, bool):
            if not math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-12):
                return False
        elif x != y:
            return False
    return True


SPARK_TO_DUCK = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def _type_issues(sdf, res) -> list[str]:
    duck = {d[0]: str(d[1]) for d in res.description}
    out = []
    for f in sdf.schema.fields:
        st = f.dataType.simpleString()
        want = SPARK_TO_DUCK.get(st)
        got = duck.get(f.name, "?")
        if want is None:
            if st.startswith("array") and got.endswith("[]"):
                continue
            out.append(f"{f.name}:{st}/{got}")
        elif want != got.upper():
            out.append(f"{f.name}:{st}/{got}")
    return out


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = local_session(8)
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    reg = load_all()
    bad = 0
    for name, q in sorted(reg.items()):
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = q.spark_df(spark, sf)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception:
            print(f"FAIL-SPARK {name}\n{traceback.format_exc()[-1500:]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = q.oracle()
        if sql is None:
            print(f"rows-only {name}: {len(srows)} rows  {ts:.1f}s")
            continue
        try:
            res = con.execute(sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as exc:
            print(f"FAIL-SQL {name}: {exc}")
            bad += 1
            continue
        issues = _type_issues(sdf, res)
        if issues:
            print(f"TYPES {name}: {issues}")
            bad += 1
        if sorted(scols) != sorted(dcols):
            print(f"COLS {name}: spark={scols} duck={dcols}")
            bad += 1
            continue
        order = sorted(scols)
        si = [scols.index(c) for c in order]
        di = [dcols.index(c) for c in order]
        sset = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=repr)
        dset = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=repr)
        if len(sset) != len(dset):
            print(f"COUNT {name}: spark={len(sset)} duck={len(dset)}")
            bad += 1
            continue
        if sset != dset:
            sset = sorted(sset, key=_coarse)
            dset = sorted(dset, key=_coarse)
        if not all(_close(a, b) for a, b in zip(sset, dset)):
            diff = [(a, b) for a, b in zip(sset, dset) if not _close(a, b)][:3]
            print(f"VALUES {name}: cols={order}\n   first diffs: {diff}")
            bad += 1
            continue
        if STRICT:
            exact_bad = sorted({order[i] for a, b in zip(sset, dset) for i, (x, y) in enumerate(zip(a, b))
                                if isinstance(x, float) and isinstance(y, float) and x != y and not (x != x and y != y)})
            if exact_bad:
                print(f"INEXACT {name}: {exact_bad}")
        print(f"ok {name}: {len(sset)} rows  {ts:.1f}s")
    print(f"mismatches: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
