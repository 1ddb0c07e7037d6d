"""Run registered queries beside their SQL and compare whole results.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

from bibspark.session import build_session
from checks.oracles import ORACLES
from checks.queries import QUERIES

TYPES = {  # one family per pair of engine type names
    "string": "text", "varchar": "text", "bigint": "int64", "int": "int32", "integer": "int32",
    "double": "float", "boolean": "bool",
}


def connect(sf: str):
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def value(x):
    return round(x, 9) if isinstance(x, float) else x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(value(r[i]) for i in order) for r in rows)


def check(spark, con, sf: str, name: str) -> str:
    df = QUERIES[name](spark, sf)
    ours = rows_of(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    described = [(d[0], str(d[1]).lower()) for d in cursor.description]
    theirs = rows_of([d[0] for d in described], cursor.fetchall())
    if sorted(df.columns) != sorted(d[0] for d in described):
        return f"columns differ: {sorted(df.columns)} / {sorted(d[0] for d in described)}"
    left = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    right = {n: TYPES.get(t, t) for n, t in described}
    if left != right:
        return f"types differ: { {n: (left[n], right[n]) for n in left if left[n] != right[n]} }"
    if ours != theirs:
        return (f"rows differ: {sum(ours.values())} / {sum(theirs.values())};"
                f" ours only {list((ours - theirs).items())[:2]}; theirs only {list((theirs - ours).items())[:2]}")
    return f"ok {sum(ours.values())}"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = check(spark, con, sf, name)
        except Exception as error:  # the next query is still worth running
            result = f"failed: {type(error).__name__}: {str(error)[:600]}"
        bad += not result.startswith("ok")
        print(f"{name:30s} {time.time() - start:6.2f}s {result}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
