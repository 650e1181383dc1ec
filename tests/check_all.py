"""python tests/check_all.py [sf_dir] [name ...]: every query against its SQL, with times."""

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from candlewick.session import local_session  # noqa: E402

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in queries.items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem) and not str(problem).startswith("rows only")
        print(f"{name:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(queries)} queries, {len(oracles)} with SQL, {bad} bad")
