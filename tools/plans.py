"""Write docs/PLANS.md: the physical plans of the queries whose shape matters.

Usage: python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

QUERIES = ("fuzzy_pairs", "golden_records", "risk_screen", "registry_table_merge", "drift_history", "dq_verdicts")
HEAD = """# Physical plans

{sf}, `local[2]`, AQE on; initial plans (AQE may still re-plan joins at run time), lines cut at {width} characters. Scans of
`corpreg/<step>` folders read intermediates that were written once under `spark.checkpoint.dir`; what was done to write them
is not part of these plans. Broadcast joins are Catalyst's size-checked choices on these small inputs. Made by
`tools/plans.py`.
"""
WIDTH = 180


def main() -> None:
    from corpreg.plans.catalog import QUERIES as ALL
    from corpreg.schemas import REGISTRY
    from corpreg.session import local_session, scratch_path
    from corpreg.sources.registry import CatalogRegistry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(2)
    spark.sparkContext.setLogLevel("ERROR")

    def shown(df) -> str:
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"#\d+L?", "", re.sub(r"file:[^\s\]]*/corpreg/([a-z-]+)-[0-9a-f]+", r"<checkpoint dir>/corpreg/\1", plan))
        return "\n".join(line[:WIDTH] for line in plan.rstrip().splitlines())

    out = [HEAD.format(sf=os.path.basename(sf.rstrip("/")), width=WIDTH)]
    for name in QUERIES:
        out.append(f"## {name}\n\n```\n{shown(ALL[name](spark, sf))}\n```\n")
    reg = CatalogRegistry(spark, "corpreg_plans.companies", buckets=16, location=scratch_path(spark, "warehouse"))
    upsert = reg.merged(spark.createDataFrame([], REGISTRY))
    out.append(f"## Upsert into the bucketed catalog table\n\n```\n{shown(upsert)}\n```\n")
    spark.sql("DROP DATABASE corpreg_plans CASCADE")
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
