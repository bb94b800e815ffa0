"""Run a registered query in Spark and its SQL check in DuckDB and compare them."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    return value if value is None else str(value)


def compare(df, con, sql: str) -> list[str]:
    """Differences between the Spark result and the SQL result; empty when equal."""
    relation = con.sql(sql)
    problems = []
    spark_types = {f.name: DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    if spark_types != duck_types:
        problems.append(f"schema: spark {sorted(spark_types.items() - duck_types.items())} "
                        f"sql {sorted(duck_types.items() - spark_types.items())}")
    names = sorted(spark_types)
    if names != sorted(duck_types):
        return problems
    ours = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    at = [relation.columns.index(n) for n in names]
    theirs = Counter(tuple(_plain(r[i]) for i in at) for r in relation.fetchall())
    if ours != theirs:
        problems.append(f"rows: spark {sum(ours.values())} sql {sum(theirs.values())}; columns {names}; "
                        f"only spark {list((ours - theirs).items())[:3]}; only sql {list((theirs - ours).items())[:3]}")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from tidemark.plans import catalog
    from tidemark.session import build_session

    sf = next((a for a in argv if a.startswith("sf")), "sf0.01")
    wanted = [a for a in argv if not a.startswith("sf")]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/{sf}"
    con = duck(sf_dir)
    bad = 0
    for name, run in catalog.QUERIES.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in catalog.CHECKS:
                problems = compare(df, con, catalog.CHECKS[name])
                note = "ok"
            else:
                problems, note = [], f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:1500]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else note:4} {name} {time.time() - start:.1f}s", *problems, flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
