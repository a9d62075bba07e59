"""Print the physical plan of registered queries.

    python -m cumulus.plans.explain [sf_dir] [name ...]

Use ``CUMULUS_NO_BROADCAST=1`` to disable size-based broadcasts and see the
shuffle plan a large cluster would run.
"""

from __future__ import annotations

import os
import sys

from ..session import get_session
from . import catalog


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(catalog.QUERIES)
    spark = get_session("local[8]", app="cumulus-explain", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("CUMULUS_NO_BROADCAST"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in names:
        print(f"===== {name}")
        catalog.build(spark, name, sf_dir).explain("formatted")


if __name__ == "__main__":
    main(sys.argv)
