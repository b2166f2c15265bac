"""Plan shape: no row-at-a-time Python anywhere, no Python at all before the detector."""
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_replay_plans_stay_in_the_jvm(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for name in ("obs_typed", "window_panes", "late_records", "points_analog", "zscores"):
        p = plan(qs[name](spark, SF_SMALL))
        assert "EvalPython" not in p and "PythonUDF" not in p, name


def test_detector_uses_arrow_batches_only(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["hst_scores"](spark, SF_SMALL))
    assert "BatchEvalPython" not in p
    p = plan(E.queries()["anomaly_full"](spark, SF_SMALL))
    assert "MapInArrow" in p and "BatchEvalPython" not in p


def test_threshold_pass_hashes_its_records(spark):
    """The watermark's pass over the records is a hash aggregate without a generator below it."""
    from telemetra.constants import FIXTURE_SPEC
    from telemetra.operators.eventtime import watermark_thresholds
    from telemetra.plans.pipeline import fixture_ok
    from telemetra.session import materialize
    p = plan(watermark_thresholds(materialize(fixture_ok(spark, SF_SMALL), True, "ok"), FIXTURE_SPEC))
    assert "SortAggregate" not in p
    # every scan feeds a hash aggregate; the generator works on its few groups
    for part in p.split("FileScan")[:-1]:
        tail = part[part.rindex("Generate"):]
        assert "HashAggregate" in tail


def test_tree_scores_shuffle_samples_not_paths(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["hst_scores"](spark, SF_SMALL))
    assert "explode" not in p and "MapInArrow" in p


def test_unset_shared_folder_is_an_error_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from telemetra.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_panes_read_the_observations_once(spark):
    """After the threshold pass: one scan of the rows, one of the thresholds; branches share exchanges."""
    import __spark_entry__ as E
    df = E.queries()["window_panes"](spark, SF_SMALL)
    df.collect()
    p = plan(df).split("== Initial Plan")[0]
    assert p.count("FileScan") == 2 and p.count("ReusedExchange") >= 2
