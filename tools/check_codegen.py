"""Report generated methods too large for HotSpot's JIT (8,000 bytes).

    python tools/check_codegen.py [sf_dir] [query ...]

Runs the registered queries with Spark's CodeGenerator log at INFO and
prints every "too long to be JIT compiled" method per query. Prints nothing
but the query names when all is well.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from airlens.plans import catalog  # noqa: E402
from airlens.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.001"
    spark = build_session("local[2]", shuffle_partitions=2)
    jvm = spark._jvm
    jvm.org.apache.logging.log4j.core.config.Configurator.setLevel(
        "org.apache.spark.sql.catalyst.expressions.codegen.CodeGenerator",
        jvm.org.apache.logging.log4j.Level.INFO)
    for name in args or list(catalog.QUERIES):
        print(f"=== {name}", flush=True)
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()


if __name__ == "__main__":
    main()
