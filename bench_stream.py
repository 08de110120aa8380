"""Streaming forms over the events of $BENCH_SF_DIR, available-now, FILES files, one per micro-batch.

    python bench_stream.py work=FOLDER [job ...]

FOLDER holds the lines and the checkpoints; without it spark.checkpoint.dir is used.
Prints one JSON line with seconds and input rows per second per job.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from datetime import timedelta

from millrace.operators import logs
from millrace.plans.inputs import Tables
from millrace.session import build_session, checkpoint_root
from millrace.sources.feeds import read_files
from millrace.streaming import jobs, keyed

FILES = 8


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench-stream", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    given = next((n.removeprefix("work=") for n in names if n.startswith("work=")), None)
    names = [n for n in names if not n.startswith("work=")]
    work = f"{checkpoint_root(spark, given)}/run-{uuid.uuid4().hex}"
    lines = Tables(spark, folder).log_lines()
    lines.repartitionByRange(FILES, "value").write.text(f"{work}/lines")
    count = lines.count()

    def pages():
        return logs.page_logs(logs.parse_logs(read_files(spark, f"{work}/lines", files_per_trigger=1)))

    def parsed():
        return logs.parse_logs(read_files(spark, f"{work}/lines", files_per_trigger=1))

    runs = {
        "parse": parsed,
        "unique_visit": lambda: keyed.unique_visits(pages(), "40 days"),
        "user_jump": lambda: keyed.user_jumps(pages(), timedelta(hours=6), "40 days", shards=16),
        "is_new_repair": lambda: keyed.repair_is_new(parsed()),
    }
    out = {}
    for name in names or runs:
        began = time.perf_counter()
        query = jobs.start(
            runs[name](), lambda batch, _: batch.write.format("noop").mode("overwrite").save(),
            checkpoint=f"{work}/checkpoint-{name}", every=None,
        )
        query.awaitTermination()
        took = time.perf_counter() - began
        out[name] = {"sec": round(took, 2), "rows_per_sec": round(count / took)}
    print(json.dumps({"metric": "available-now stream", "rows": count, "micro_batches": FILES, "jobs": out}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
