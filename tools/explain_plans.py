"""Run registered jobs and print their final (adaptive) physical plans.

Usage: python tools/explain_plans.py [sf_dir] key [key ...]

Each job is executed once (``noop`` sink) so AQE's final plan is shown: join
strategies picked from measured sizes, coalesced shuffle reads, reused
exchanges, the whole-stage-codegen spans (``*(n)``) and pushed scan filters.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bayesmill.plans import registry  # noqa: E402
from bayesmill.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session()
    qs = registry.queries()
    for k in args or ["nb_predict"]:
        df = qs[k](spark, sf)
        plan = df._jdf.queryExecution().executedPlan()
        plan.execute().count()          # run this plan in the JVM; no rows come to Python
        print(f"===== {k}")
        print(plan.toString())


if __name__ == "__main__":
    main()
