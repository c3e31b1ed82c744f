"""SQL files and DataFrame plans of the same queries give equal fingerprints."""

import __spark_entry__ as entry_point
from lakeloom.operators import runs
from lakeloom.plans import suite

NAMES = ["star_topk_class", "revenue_ratio", "threshold_customers"]
FOLDER = "/root/testdata/sf0.001"


def test_files_against_plans(spark, tmp_path):
    sql = entry_point.oracle_sql()
    for n in NAMES:
        (tmp_path / f"{n}.sql").write_text(sql[n] + ";\n")
    (tmp_path / "broken.sql").write_text("SELECT nothing FROM nowhere")
    (tmp_path / "list.txt").write_text("# all\n" + "\n".join(f"{n}.sql" for n in NAMES) + "\n\nbroken.sql\n")
    files = suite.listed_files(str(tmp_path / "list.txt"))
    assert [f.stem for f in files] == NAMES + ["broken"]
    suite.registered_tables(spark, FOLDER, ["orders", "lineitem", "part", "customer", "supplier", "nation", "region"])
    by_sql = suite.record_runs(spark, suite.sql_plans(spark, files), "sql", runs=1, warmups=1)
    queries = entry_point.queries()
    by_plan = suite.record_runs(spark, {n: (lambda n=n: queries[n](spark, FOLDER)) for n in NAMES}, "plan")
    both = by_sql.unionByName(by_plan).cache()
    pairs = {r.query_name: (r.matches, r.same_rows) for r in runs.validation(both, "sql", "plan").collect()}
    assert pairs == {n: (True, True) for n in NAMES}
    summary = {r.engine: r for r in runs.run_summary(both).collect()}
    assert (summary["sql"].total_queries, summary["sql"].failure_count, summary["plan"].success_count) == (4, 1, 3)
    assert both.filter("run_type = 'warmup'").count() == 4
    metrics = spark.createDataFrame([("plan-revenue_ratio-0", 7, 8, 9)], "query_id string, peak_memory_bytes long, spill_bytes long, cpu_time_millis long")
    filled = suite.with_task_metrics(both, metrics).filter("engine = 'plan' AND query_name = 'revenue_ratio'").first()
    assert (filled.peak_memory_bytes, filled.spill_bytes, filled.cpu_time_millis) == (7, 8, 9)
