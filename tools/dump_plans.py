"""Write the formatted physical plans of the bench's headline queries to
docs/plans/, with auto-broadcast disabled (the shape the plans take when the
tables are too big to broadcast). Usage: python tools/dump_plans.py [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from adlens.plans.catalog import catalog  # noqa: E402
from adlens.plans.inspect import plan_text  # noqa: E402
from adlens.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out, exist_ok=True)
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in bench.HEADLINE:
        text = plan_text(catalog()[name](spark, sf))
        text = "\n".join(line for line in text.splitlines() if not line.startswith("Location:"))
        with open(os.path.join(out, f"{name}.txt"), "w") as f:
            f.write(f"# {name}: physical plan, auto-broadcast disabled, input {os.path.basename(sf)}\n\n{text}\n")


if __name__ == "__main__":
    main()
