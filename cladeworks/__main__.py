"""`python -m cladeworks QUERY SF_DIR [OUT]` runs a named query; `python -m cladeworks --list` names them."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from .plans import registry
from .plans.engine import EXIT


def main(args: list[str]) -> int:
    if args == ["--list"]:
        print("\n".join(sorted(registry.QUERIES)))
        return EXIT["ok"]
    if len(args) not in (2, 3) or args[0] not in registry.QUERIES:
        print(__doc__, file=sys.stderr)
        return EXIT["usage"]
    df = registry.QUERIES[args[0]](SparkSession.builder.appName("cladeworks").getOrCreate(), args[1])
    if len(args) == 3:
        df.write.parquet(args[2])
    else:
        df.show(50, truncate=False)
    return EXIT["ok"]


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
