"""Benchmark: the whole concept pipeline at $BENCH_SF_DIR on local[$BENCH_CPUS].

Runs every query key in dependency order inside one pipeline (as the scripts
run in sequence, each reading the stored results of the earlier ones): shared
concepts are stored once and reused.  Per key it records the seconds to build
that key's result on top of what is stored and to write it to a sink that
discards rows, so nothing is collected; the rows are counted on the way.
``load`` is the step that derives the clinical tables from the input.  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stayframe.plans import registry  # noqa: E402
from stayframe.plans.base import Concepts  # noqa: E402
from stayframe.session import get_spark  # noqa: E402
from stayframe.sources.fixture import Tables  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "16")),
                      app="stayframe-bench")
    concepts = Concepts(Tables(spark, sf_dir))
    per_key: dict[str, float] = {}
    rows: dict[str, int] = {}
    t_all = time.time()
    for name in ("icustays", "admissions", "event_rows"):
        getattr(concepts.t, name)
    per_key["load"] = round(time.time() - t_all, 3)
    for key, name in registry.QUERY_KEYS.items():
        t0 = time.time()
        seen = Observation(key)
        out = concepts.output(name).observe(seen, F.count(F.lit(1)).alias("n"))
        out.write.format("noop").mode("overwrite").save()
        rows[key] = seen.get["n"]
        per_key[key] = round(time.time() - t0, 3)
    total = round(time.time() - t_all, 3)
    concepts.release()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "pipeline_seconds", "value": total, "unit": "sec",
        "queries": per_key, "rows": rows, "sf": sf, "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
