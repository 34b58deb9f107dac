"""Run the word count with report over a folder and print, from the event log,
how many lines its scans of that folder read, and what its tasks wrote."""

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from linecraft.plans.jobs import log_analysis_job, word_count_with_report_job  # noqa: E402

work, what = sys.argv[1:]
spark = (
    SparkSession.builder.master("local[2]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.files.maxPartitionBytes", "64k")
    .config("spark.sql.files.openCostInBytes", "64k")
    .config("spark.eventLog.enabled", "true")
    .config("spark.eventLog.compress", "false")
    .config("spark.eventLog.rolling.enabled", "false")
    .config("spark.eventLog.dir", f"file://{work}/events")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
if what == "words":
    word_count_with_report_job(spark, f"{work}/in", f"{work}/words", f"{work}/report")
else:
    log_analysis_job(spark, f"{work}/in", f"{work}/records", rejects_path=f"{work}/rejects")
spark.stop()
read = written = 0
for path in glob.glob(f"{work}/events/*"):
    with open(path) as f:
        for line in f:
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                read += e["Task Metrics"]["Input Metrics"]["Records Read"]
                written += e["Task Metrics"]["Output Metrics"]["Bytes Written"]
print(json.dumps({"read": read, "written": written}))
