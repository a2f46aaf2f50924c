"""Physical-plan census of every registered query as planned for large inputs.

AQE and automatic broadcast are switched off, so only the library's own
size-checked broadcast hints appear; writes PLANS.md.
usage: python tests/plan_report.py [sf_dir]
"""
import os
import re
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from commentguard.session import local_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402

SKIP = ("q_stream_", "q_fit_", "op", "pipeline")  # these run jobs when called (streams, model fits)


def census(plan: str) -> dict:
    lines = plan.splitlines()
    ex = [x for x in lines if re.search(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin", x) and "Reused" not in x and "Broadcast" not in x]
    return {
        "shuffles": len(ex),
        "single": sum("SinglePartition" in x for x in ex),
        "reused": sum("ReusedExchange" in x for x in lines),
        "bhj": sum("BroadcastHashJoin" in x for x in lines),
        "smj": sum("SortMergeJoin" in x for x in lines),
        "shj": sum("ShuffledHashJoin" in x for x in lines),
        "window": sum(re.search(r"\bWindow\b", x) is not None for x in lines),
        "python": sum(("EvalPython" in x or "MapInPandas" in x or "PythonUDF" in x) for x in lines),
        "take_ordered": sum("TakeOrderedAndProject" in x for x in lines),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = []
    for name, q in E.queries().items():
        if name.startswith(SKIP):
            continue
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        rows.append((name, census(plan)))
    cols = ["shuffles", "single", "reused", "bhj", "smj", "shj", "window", "python", "take_ordered"]
    out = ["# PLANS — physical-plan census (AQE off, auto-broadcast off)", "",
           "Generated by `tests/plan_report.py`. `shuffles` counts hash/range/single-partition exchanges",
           "(broadcasts excluded); `single` = exchanges to one partition; `bhj` joins use the library's",
           "size-checked broadcast hints only.", "",
           "| query | " + " | ".join(cols) + " |", "|---|" + "---|" * len(cols)]
    for name, c in rows:
        out.append(f"| {name} | " + " | ".join(str(c[k]) for k in cols) + " |")
    with open(os.path.join(os.path.dirname(HERE), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out))


if __name__ == "__main__":
    main()
