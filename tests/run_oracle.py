"""Compare every query with its oracle: python tests/run_oracle.py <sf dir> [names]."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

import __spark_entry__ as entry  # noqa: E402
from oracle import connect, differences  # noqa: E402

from marlstone.session import build_session  # noqa: E402


def main(sf_dir: str, only: list[str]) -> int:
    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if name not in (only or entry.library_queries()):
            continue
        started = time.time()
        try:
            diff = differences(spark, con, query, sql[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            diff = {"error": str(e)[:1500]}
        failed += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - started:.1f}s", diff or "")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
