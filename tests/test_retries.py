"""Tasks that fail once are run again: counts and stored rows must not notice."""

import json
import subprocess
import sys
from pathlib import Path

SCRIPT = '''
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from wardlake.operators.clean import clean_admissions
from wardlake.operators.validate import pack_rejected
from wardlake.plans.store import ClinicalStore
from wardlake.sources.generate import generate_admissions, generate_patients
from wardlake.sources.images import export_blobs

spark = (SparkSession.builder.master("local[3,4]").config("spark.sql.shuffle.partitions", "3")
         .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def flaky(batches):
    for batch in batches:
        yield batch
    # after the rows were handed on, so that the first attempt has already written some
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("first attempt")

def shaky(df):
    return df.mapInPandas(flaky, df.schema)

keys = spark.range(0, 600, 1, 4).withColumnRenamed("id", "key")
patients = generate_patients(keys, 0.0, 1)
admissions = generate_admissions(keys, patients, 0.1, 2)
store = ClinicalStore(spark, sys.argv[2] + "/store")
stats = store.load_batch(shaky(patients), clean_admissions(shaky(admissions)))
expected = clean_admissions(admissions).join(patients, F.col("patient_external_id") == F.col("external_id"), "left_semi")
rejects = pack_rejected(admissions.withColumn("rejection_reason", F.lit("x")), "admissions.csv")
blobs = admissions.limit(50).select(F.lit("b").alias("bucket"), F.concat(F.lit("k/"), F.xxhash64("*").cast("string")).alias("object_key"),
                                    F.encode("department", "UTF-8").alias("content")).distinct()
store.put_objects(shaky(blobs))
written = export_blobs(shaky(store.blob_contents()), sys.argv[2] + "/out").count()
print(json.dumps({
    "stats": stats,
    "patients": store.patients().count(),
    "admissions": [store.admissions().count(), expected.count()],
    "rejected": store.write_rejected(shaky(rejects), "r"),
    "objects": [store.blobs().count(), written],
}))
'''


def test_failed_tasks_leave_no_trace(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    run = subprocess.run([sys.executable, "-c", SCRIPT, root, str(tmp_path)], capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    got = json.loads(run.stdout.strip().splitlines()[-1])
    assert got["stats"] == {"upserted": 600, "modified": 0} and got["patients"] == 600
    assert got["admissions"][0] == got["admissions"][1] > 400
    assert got["rejected"] == 600
    assert got["objects"][0] == got["objects"][1] > 0
    files = [p for p in (tmp_path / "out").rglob("*") if p.is_file() and not p.name.startswith(".")]
    assert len(files) == got["objects"][0]
