"""Run registered queries on a folder of tables and compare them with their SQL in DuckDB."""

import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

# The result types that count as equal on both sides.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(rows):
    def cell(v):
        if v is None or v != v:
            return (0, "")
        return (1, f"{v:.9g}") if isinstance(v, float) else (1, str(v))

    return sorted(tuple(cell(v) for v in row) for row in rows)


def differences(df, con, sql) -> str | None:
    """What differs between a Spark result and the result of a SQL statement."""
    expected = con.execute(sql)
    types = {d[0]: str(d[1]) for d in expected.description}
    have = {f.name: SAME_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    want_types = {c: {"NUMBER": None, "STRING": "VARCHAR"}.get(t, t) for c, t in types.items()}
    names = sorted(want_types)
    if names != sorted(have):
        return f"columns {sorted(have)} against {names}"
    wrong = [f"{c}: {have[c]} against {want_types[c]}" for c in names if want_types[c] and want_types[c] != have[c]]
    if wrong:
        return f"types {wrong}"
    order = [list(types).index(c) for c in names]
    want = canonical([tuple(r[i] for i in order) for r in expected.fetchall()])
    got = canonical([tuple(r) for r in df.select(*[f"`{c}`" for c in names]).collect()])
    if len(want) != len(got):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want, strict=True) if g != w]
    return f"{len(bad)} of {len(want)} rows differ, first {names}: {bad[0]}" if bad else None


def main(folder: str, chosen: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if name in sql:
                found = differences(df, con, sql[name])
            else:
                rows = df.collect()
                found = None if rows else "no rows"
                print("   ", rows[:3])
        except Exception as e:  # noqa: BLE001
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
