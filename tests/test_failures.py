"""Tasks that fail and run again must neither lose nor repeat rows, nor count them twice.

Needs a session that retries tasks, so it runs in a process of its own.
"""

import json
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import json, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession
from tripmill.operators import documents, table
from tripmill.operators.documents import document_schema
from tripmill.session import use_zone
from tripmill.sources.documents import read_documents

spark = (
    SparkSession.builder.master("local[4, 3]")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.warehouse.dir", sys.argv[1] + "/warehouse")
    .getOrCreate()
)
use_zone(spark)

def fail_once(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch
    if context.attemptNumber() == 0 and context.partitionId() in (1, 6):
        raise RuntimeError("lost on purpose")

rows = spark.range(0, 8000, 1, 8).selectExpr("id as a", "concat('2024-01-0', 1 + id % 3) as date")
rows = rows.mapInArrow(fail_once, rows.schema)
found = {}
for cluster in (True, False):
    name, root = f"default.t_{cluster}".lower(), f"{sys.argv[1]}/documents_{cluster}"
    written = table.write(rows, name, cluster=cluster).rows
    sent = documents.write(rows, root, "d-{date}", cluster=cluster).rows
    back = read_documents(spark, root, document_schema(rows.schema))
    found[str(cluster)] = [
        written, spark.table(name).count(), spark.table(name).distinct().count(),
        sent, back.count(), back.distinct().count(),
    ]
print(json.dumps(found))
"""


def test_retried_tasks(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path)],
        cwd=Path(__file__).parent.parent,
        capture_output=True,
        text=True,
        timeout=300,
        check=True,
    )
    assert json.loads(run.stdout.splitlines()[-1]) == {"True": [8000] * 6, "False": [8000] * 6}
    assert "lost on purpose" in run.stderr
