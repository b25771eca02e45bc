"""Formatted physical plans of concepts (each one's own plan, with the concepts it
reads already stored), printed, or written to a folder without paths and ids.

usage: python tools/explain_key.py [--out FOLDER] [--sf DIR] KEY...
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayframe.plans import registry  # noqa: E402
from stayframe.plans.base import BUILDERS, Concepts  # noqa: E402
from stayframe.session import get_spark  # noqa: E402
from stayframe.sources.fixture import Tables  # noqa: E402


def main() -> None:
    args = argparse.ArgumentParser()
    args.add_argument("--out")
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("keys", nargs="+")
    opt = args.parse_args()
    spark = get_spark(os.environ.get("EXPLAIN_CPUS", "8"), 16)
    c = Concepts(Tables(spark, opt.sf))
    for key in opt.keys:
        df = BUILDERS[registry.QUERY_KEYS.get(key, key)](c)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        if not opt.out:
            print(text)
            continue
        text = re.sub(r"#\d+L?", "", re.sub(r"file:/\S*?/stayframe/[0-9a-f]{12}/", "", text))
        with open(os.path.join(opt.out, f"{key}.txt"), "w") as f:
            f.write(text)


if __name__ == "__main__":
    main()
