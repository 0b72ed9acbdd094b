"""Run one registered query with the Spark event log on and print the slowest stages.

    python scripts/stage_times.py name [sf_dir]
"""
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from coclick.plans import catalog  # noqa: E402
from coclick.session import build_session  # noqa: E402

name = sys.argv[1]
sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
logdir = tempfile.mkdtemp(prefix="evlog-", dir="/tmp")
spark = build_session("local[8]", shuffle_partitions=16,
                      extra={"spark.driver.memory": "16g", "spark.eventLog.enabled": "true",
                             "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false"})
spark.sparkContext.setLogLevel("ERROR")
if os.environ.get("WARM", "1") == "1":
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
t = time.perf_counter()
catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
print("total", round(time.perf_counter() - t, 2))
spark.stop()
stages = {}
read_total = 0
for f in [p for p in glob.glob(logdir + "/**", recursive=True) if os.path.isfile(p)]:
    for line in open(f):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerStageCompleted":
            i = e["Stage Info"]
            if "Submission Time" in i and "Completion Time" in i:
                rec = sum(a.get("Value", 0) for a in i.get("Accumulables", []) if a.get("Name") == "internal.metrics.shuffle.write.recordsWritten")
                rd = sum(a.get("Value", 0) for a in i.get("Accumulables", [])
                         if a.get("Name") == "internal.metrics.input.recordsRead")
                read_total += rd
                if rd and os.environ.get("SHOW_READS"):
                    print("  reads", int(rd), "stage", i["Stage ID"])
                rdds = ",".join(sorted({r.get("Scope", "{}") and json.loads(r.get("Scope", "{}")).get("name", "")
                                        for r in i.get("RDD Info", []) if r.get("Scope")}))
                stages[i["Stage ID"]] = (i["Completion Time"] - i["Submission Time"], i["Number of Tasks"], rec,
                                         rdds[:110], "")
print("input records read (all scans):", int(read_total))
for sid, (ms, n, rec, nm, _) in sorted(stages.items(), key=lambda x: -x[1][0])[:12]:
    print(f"stage {sid:4d} {ms:6d} ms tasks={n:4d} shuffle_rows={int(rec):10d} {nm}")
