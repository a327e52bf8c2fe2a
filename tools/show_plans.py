"""Run registered queries and print their FINAL adaptive physical plans.

``DataFrame.explain`` before execution shows AQE's initial plan; the final
plan (reused exchanges, runtime broadcasts, coalesced partitions) is read
back from Spark's event log, written to a fresh scratch folder.

Usage: python tools/show_plans.py SF_DIR name [name ...]
"""

from __future__ import annotations

import glob
import json
import sys
import tempfile

sys.path.insert(0, ".")


def main() -> None:
    from pyspark.sql import SparkSession

    sf, names = sys.argv[1], sys.argv[2:]
    logdir = tempfile.mkdtemp(prefix="lf-plans-")
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "16")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", logdir)
             .config("spark.eventLog.compress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerflow.bindings.registry import QUERIES
    from ledgerflow.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    for name in names:
        df = QUERIES[name](spark, sf)
        spark.sparkContext.setJobDescription(f"plan:{name}")
        df.write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobDescription(None)
    spark.stop()
    tagged, finals = {}, {}
    for f in glob.glob(f"{logdir}/**/*", recursive=True):
        if "events" not in f:
            continue
        for line in open(f):
            e = json.loads(line)
            if e["Event"].endswith("SparkListenerSQLExecutionStart") and str(e.get("description", "")).startswith("plan:"):
                tagged[e["executionId"]] = e["description"][5:]
                finals.setdefault(e["executionId"], e["physicalPlanDescription"])
            if e["Event"].endswith("SparkListenerSQLAdaptiveExecutionUpdate"):
                finals[e["executionId"]] = e["physicalPlanDescription"]  # the last update is the final plan
    for eid, name in sorted(tagged.items()):
        print(f"===== {name}")
        print(finals.get(eid, "(no adaptive plan)").split("\n\n")[0])


if __name__ == "__main__":
    main()
