"""Command line.

    python -m tristar --list
    python -m tristar run verified_users_by_id --sf /root/testdata/sf0.01 [--explain]
    python -m tristar count --sf /root/testdata/sf0.01 --mapping batch --by name --threshold 600

``count`` prints each qualifying user and count on a line, then how many there were;
``run`` prints any registry query: all rows, or the first ``--rows`` and a note that it cut.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristar.operators.counts import verified_users
from tristar.plans.registry import QUERIES
from tristar.session import get_session
from tristar.sources.roles import WORKLOAD_THRESHOLD, batch_star, event_star


def report(df: DataFrame) -> int:
    """Print the qualifying users, largest count first; return how many there were.

    ``toLocalIterator`` fetches one partition at a time, so the driver holds one
    partition of the (already aggregated) result, never all of it.
    """
    n = 0
    for r in df.orderBy(F.desc("counts"), "user_name").toLocalIterator():
        print(f"{r['counts']:>12}  {r['user_name']}")
        n += 1
    return n


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="tristar")
    p.add_argument("--list", action="store_true", help="list the registry queries")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd")
    r = sub.add_parser("run", help="run a registry query and show it")
    r.add_argument("query")
    r.add_argument("--sf", default="/root/testdata/sf0.01")
    r.add_argument("--rows", type=int, default=0, help="print at most so many rows (0: all)")
    r.add_argument("--explain", action="store_true", help="print the formatted plan instead")
    c = sub.add_parser("count", help="users with more than a threshold of verifications")
    c.add_argument("--sf", default="/root/testdata/sf0.01")
    c.add_argument("--mapping", choices=["batch", "events"], default="batch")
    c.add_argument("--by", choices=["id", "name", "id_and_name"], default="id")
    c.add_argument("--threshold", type=int, default=WORKLOAD_THRESHOLD)
    a = p.parse_args(argv)
    if a.list or not a.cmd:
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = get_session(a.master)
    try:
        if a.cmd == "run":
            df = QUERIES[a.query](spark, a.sf)
            if a.explain:
                df.explain("formatted")
            else:
                shown, cut = 0, False
                for row in df.toLocalIterator():
                    if cut := bool(a.rows) and shown >= a.rows:
                        break
                    print(*row, sep="\t")
                    shown += 1
                print(f"first {shown} rows, more follow" if cut else f"{shown} rows")
        else:
            star = (batch_star if a.mapping == "batch" else event_star)(spark, a.sf)
            df = verified_users(*star, by=a.by, threshold=a.threshold)
            n = report(df)
            print(f"{n} users have more than {a.threshold} verifications")
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
