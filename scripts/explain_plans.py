"""Print the formatted physical plan of registered queries (pushdown, pruning, exchanges).

usage: python scripts/explain_plans.py [sf_dir] name ...
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tunesmith.plans import catalog  # noqa: E402
from tunesmith.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    for name in sys.argv[2:]:
        print(f"===== {name}")
        catalog.QUERIES[name](spark, sf_dir).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
