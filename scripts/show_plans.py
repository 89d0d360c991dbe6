"""Print the formatted physical plan of registered queries.

    python scripts/show_plans.py [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.registered import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tidemark-warehouse-")})
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf_dir).explain("formatted")


if __name__ == "__main__":
    main()
