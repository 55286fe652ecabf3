"""The gate on logs with missing parts, cleaning, and the runner of steps."""

from pyspark.sql import functions as F

from scriptorium.plans import gate

LOG = f"k int, log_path string, overall_state string, records {gate.RECORDS}"


def test_gate_on_missing_parts(spark):
    codes = ["structural_signal.a.1", "structural_signal", None, "noise_signal.candidate", "other.x"]
    records = [(i, i, c) for i, c in enumerate(codes)] + [(9, i, "warning_signal.unclassified") for i in range(50)]
    logs = spark.createDataFrame([(1, "l1", "NO ISSUE DETECTED", records), (2, "l2", None, None), (3, "l3", "OUT OF SCOPE FINDING", []), (5, "l5", "", [])], LOG)
    made = {r.k: r for r in gate.gate_records(logs, "k").collect()}
    assert (made[1].n_structural_signal, made[1].n_warning_signal, made[1].n_noise_signal, made[1].source_count) == (1, 50, 1, 55)
    assert made[2].refused.endswith("UNCERTAIN") and made[5].refused.endswith("UNCERTAIN") and not made[2].confirmed and made[2].source_digest is None
    projects = spark.range(1, 6).select(F.col("id").cast("int").alias("k"))
    given = gate.gate_records(logs, "k").filter("k <> 2").withColumn("confirmed", F.when(F.col("k") != 3, F.col("confirmed")))
    checked = gate.gate_check(projects, logs, given, "k")
    assert {r.k: r.failure for r in checked.collect()} == {1: None, 2: "stage2.findings_blocking", 3: "stage2.confirmation_unapproved", 4: "stage2.finding_log_missing", 5: "stage2.findings_blocking"}
    report = {r.k: r for r in gate.diagnostic_report(checked, "k", F.lit(None).cast("boolean"), ("FM-001", "FM-003")).collect()}
    assert 4 not in report and report[1].system_state == "PASS" and report[1].failure_modes == []
    assert [tuple(x) for x in report[1].key_signals] == [("structural_signal.a", "low"), ("warning_signal.unclassified", "high"), ("noise_signal.candidate", "low")]
    assert report[3].failure_modes == ["FM-003"] and report[3].checks == [gate.CHECKS[""], gate.CHECKS["FAIL"]] and report[3].causes == [gate.CAUSES[""]]
    empty = logs.filter("false")
    assert gate.gate_records(empty, "k").count() == 0 and {r.failure for r in gate.gate_check(projects, empty, given.filter("false"), "k").collect()} == {"stage2.finding_log_missing"}


def test_clean_candidates(spark):
    names = ["translated-p1-4.json", "translated-p2-5.json", "translated-x.json", "draft.json", "notes.json"]
    files = spark.createDataFrame([("a", "batches", n) for n in names] + [("a", "dist", "page.html"), ("a", "dist", "old.html"), ("b", "batches", "draft.json"), ("b", "batches", "translated-px-9.json")], "project string, folder string, name string")
    left = {(r.project, r.name) for r in gate.clean_candidates(files, "project", {"dist": ("page.html",)}, keep_draft=True).collect()}
    assert left == {("a", "translated-p1-4.json"), ("a", "translated-x.json"), ("a", "notes.json"), ("a", "old.html")}


def test_steps_stop_at_the_first_failure():
    ran = []
    done = gate.run_steps([("one", lambda: ran.append(1)), ("two", lambda: 1 // 0), ("three", lambda: ran.append(3))])
    assert ran == [1] and [n for n, _ in done] == ["one", "two"] and done[0][1] is None and isinstance(done[1][1], ZeroDivisionError)
