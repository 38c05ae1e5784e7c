"""Compare queries with their SQL: python tests/check_oracle.py SF_DIR [name ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

import oracle  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from wattsift.session import local_session  # noqa: E402


def main() -> None:
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    todo, sql = queries(), oracle_sql()
    for name in names or todo:
        started = time.perf_counter()
        try:
            df = todo[name](spark, sf_dir)
            columns, mine = oracle.spark_rows(df)
            spent = time.perf_counter() - started
            if name not in sql:
                print(f"ROWS {name} {len(mine)} rows {spent:.1f}s", flush=True)
                continue
            started = time.perf_counter()
            theirs_columns, theirs = oracle.duck_rows(con, sql[name])
            duck = time.perf_counter() - started
            bad = oracle.differences(mine, theirs) if columns == theirs_columns else [f"{columns} | {theirs_columns}"]
            kinds = oracle.type_differences(df, con, sql[name])
            state = "OK  " if not bad and not kinds else "TYPE" if not bad else "BAD "
            print(f"{state} {name} {len(mine)} rows spark {spent:.1f}s sql {duck:.1f}s {kinds or ''}", flush=True)
            for line in bad:
                print("     ", line[:600], flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"FAIL {name} {type(error).__name__}: {str(error)[:700]}", flush=True)


if __name__ == "__main__":
    main()
