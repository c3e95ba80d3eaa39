"""Run the registered queries in Spark and DuckDB and compare the results.

    python -m checks.compare [--sf DIR] [--out FILE] [query ...]
"""

from __future__ import annotations

import argparse
import json
import math
import time
from collections import Counter

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def oracle_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else (v if v != 0 else 0.0)
    if isinstance(v, int):
        return float(v)
    return v


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str, run, sql: str | None) -> dict:
    t = time.time()
    df = run(spark, sf_dir)
    got = df.collect()
    out = {"query": name, "rows": len(got), "spark_sec": round(time.time() - t, 2)}
    if sql is None:
        return {**out, "status": "rows only"}
    t = time.time()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    out["oracle_sec"] = round(time.time() - t, 2)
    if sorted(names) != sorted(df.columns):
        return {**out, "status": f"columns {sorted(names)} != {sorted(df.columns)}"}
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a == b:
        return {**out, "status": "match"}
    return {**out, "status": "DIFFER", "oracle_rows": len(want),
            "only_spark": [str(x) for x in list((a - b))[:3]], "only_oracle": [str(x) for x in list((b - a))[:3]],
            "n_only_spark": sum((a - b).values())}


def main() -> None:
    from checks.oracles import ORACLES
    from checks.queries import QUERIES
    from limnia.session import build_session

    p = argparse.ArgumentParser()
    p.add_argument("--sf", default="/root/testdata/sf0.01")
    p.add_argument("--out")
    p.add_argument("names", nargs="*")
    a = p.parse_args()
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")
    con = oracle_connection(a.sf)
    results = []
    for name in a.names or QUERIES:
        try:
            r = compare(spark, con, name, a.sf, QUERIES[name], ORACLES.get(name))
        except Exception as e:  # report and go on with the other queries
            r = {"query": name, "status": "ERROR " + str(e)[:700]}
        results.append(r)
        print(json.dumps(r, ensure_ascii=False), flush=True)
    bad = [r["query"] for r in results if r["status"] not in ("match", "rows only")]
    print(f"{len(results)} queries, {len(bad)} bad: {bad}")
    if a.out:
        with open(a.out, "w") as f:
            json.dump(results, f, indent=1)


if __name__ == "__main__":
    main()
