import random

from termloom.operators import workflow
from termloom.streaming import tasks


def run(df, name, mode):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()


def test_task_states_equal_batch(spark, tmp_path):
    rng = random.Random(4)
    rows = [(k, i, rng.choice(workflow.STATES[:5])) for k in range(8) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, seq long, status string")
    path = str(tmp_path / "in")
    df.coalesce(1).write.parquet(path)
    run(tasks.task_states(spark.readStream.schema(df.schema).parquet(path)), "states", "update")
    got = {(r.doc_id, r.state, r.refused) for r in spark.sql("SELECT * FROM states").collect()}
    assert got == {tuple(r) for r in workflow.folded_states(df, "doc_id", "seq", "status").collect()}


def test_landing_stream(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Collateral Eligibility Schedule\nEligible Collateral\nAgreement ID: 1\nSchedule Version: 2\n")
    (tmp_path / "b.txt").write_text((tmp_path / "a.txt").read_text())
    (tmp_path / "c.md").write_text("note")
    (tmp_path / "d.csv").write_text("no")
    run(tasks.landed(spark, str(tmp_path)), "landed", "append")
    got = sorted(r.doc_class for r in spark.sql("SELECT * FROM landed").collect())
    assert got == ["collateral_eligibility_schedule", "unknown"]
