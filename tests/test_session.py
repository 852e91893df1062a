"""Lineage cuts go to the shared folder named by spark.checkpoint.dir."""

from pyspark.sql import functions as F

from ledgerline.session import drop_written, ensure_checkpoint_dir, materialize


def test_checkpoint_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    folder = ensure_checkpoint_dir(spark)
    assert configured.rstrip("/").split("/")[-1] in folder


def test_materialize_writes_under_the_checkpoint_folder(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    written = materialize(df)
    folder = ensure_checkpoint_dir(spark).replace("file:", "")
    assert all(folder in f.replace("file:", "") for f in written.inputFiles())
    assert sorted(r.x for r in written.collect()) == [2 * i for i in range(10)]


def test_written_tables_are_dropped(spark):
    import os
    folder = ensure_checkpoint_dir(spark).replace("file:", "")
    drop_written(spark)
    before = set(os.listdir(folder))
    materialize(spark.range(3))
    assert len(set(os.listdir(folder)) - before) == 1
    assert drop_written(spark) == 1 and set(os.listdir(folder)) == before


def test_report_with_one_reader_writes_no_table_and_none_is_left(spark):
    """The same plan at every size: r04 reads the order dates only; r07 writes its view once."""
    import os

    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    drop_written(spark)
    for name in ["r04_date_dimension", "r05_question_tags", "r06_tag_dimension", "r10_missing_synonym_targets",
                 "r11_untagged_questions", "s10_dim_tags_key_check"]:
        E.queries()[name](spark, sf).collect()
        assert drop_written(spark) == 0, name
    E.queries()["r07_fact_detail"](spark, sf).collect()
    assert drop_written(spark) == 1
    folder = ensure_checkpoint_dir(spark).replace("file:", "")
    assert not [f for f in os.listdir(folder) if f.startswith("ledgerline-table-")]


def _collect_garbage(spark):
    import gc
    import time
    for _ in range(6):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def test_a_table_goes_with_its_last_reader(spark):
    from ledgerline.session import drop_unread, path_exists, written_tables
    drop_written(spark)
    first = materialize(spark.range(5))
    path = next(iter(written_tables(spark)))
    derived = first.select((F.col("id") + 1).alias("x")).where("x > 2")      # a plan over it, without the DataFrame
    del first
    _collect_garbage(spark)
    assert drop_unread(spark) == 0 and derived.count() == 3
    del derived
    _collect_garbage(spark)
    assert drop_unread(spark) == 1 and not path_exists(spark, path) and not written_tables(spark)


def test_a_scope_keeps_what_its_result_reads(spark):
    from ledgerline.session import TableScope, written_tables
    drop_written(spark)
    outer = materialize(spark.range(4))
    with TableScope(spark) as scope:
        a, b, c = (materialize(spark.range(n)) for n in (5, 6, 7))
        out = scope.result(a.join(outer, "id").withColumn("n", b.select(F.count(F.lit(1))).scalar()))
        assert c.count() == 7
    assert len(written_tables(spark)) == 3                   # outer, a and the subquery's b
    assert sorted(map(tuple, out.collect())) == [(i, 6) for i in range(4)] and outer.count() == 4


def test_sessions_own_their_tables_and_leave_nothing(scratch_dir):
    """A process that never calls drop_written leaves its folder empty."""
    import os
    import subprocess
    import sys
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from ledgerline.session import build_session, materialize, written_tables
spark = build_session("local[1]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {scratch_dir!r}}})
kept = materialize(spark.range(3))
other = spark.newSession()
assert not written_tables(other) and len(written_tables(spark)) == 1
import os
print(sum(len(f) for _, _, f in os.walk({scratch_dir!r})))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 0, done.stderr[-2000:]
    assert not [f for _, _, files in os.walk(scratch_dir) for f in files]


def test_reports_leave_nothing_behind(spark):
    import __spark_entry__ as E
    from ledgerline.session import drop_unread, written_tables
    sf = "/root/testdata/sf0.001"
    drop_written(spark)
    for name in ["r28_price_tail_share", "r32c_tree_closure", "s07_reloaded_cube_report", "s01_xml_experts", "s01r_xml_rejects",
                 "r01t_topic_experts_table", "f02_text_date_rejects"]:
        E.queries()[name](spark, sf).collect()
        _collect_garbage(spark)
        drop_unread(spark)
        assert not written_tables(spark), name
