"""Print the formatted physical plan of registered queries (plan review aid).

Usage: python tests/explain_plans.py [sf_dir] name [name ...]
Streaming/file queries run their writes first (they return a read of the result).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

if __name__ == "__main__":
    from covenant.session import local_session

    import __spark_entry__ as e

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = local_session()
    qs = e.queries()
    for name in args or ["dq_metrics", "dq_unique", "jn_left_fanout"]:
        print(f"===== {name} =====", flush=True)
        qs[name](spark, sf).explain("formatted")
