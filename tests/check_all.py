"""python -m tests.check_all [sf_dir] [query ...]: every query against its SQL, with times."""

import sys
import time

import __spark_entry__ as contract
from starweave.session import build_session
from tests.compare import difference, oracle


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in args[1:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            got = df.toPandas()
            took = time.time() - start
            found = difference(got, oracle(sql[name], sf_dir)) if name in sql else "no SQL"
        except Exception as e:  # report and go on with the next query
            took, found = time.time() - start, f"{type(e).__name__}: {str(e)[:400]}"
        failed += found is not None
        print(f"{name:32s} {took:6.2f}s  {len(got) if found is None else ''} {found or 'ok'}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
