from brandlink.session import cut_lineage, ensure_checkpoint_dir, free_shuffles


def test_checkpoint_dir_reused(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first


def test_cut_lineage_is_reliable_checkpoint(spark):
    df = spark.range(10).selectExpr("id * 2 AS x")
    cp = cut_lineage(df)
    plan = cp._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" in plan and cp.count() == 10


def test_shuffle_files_of_finished_steps_go(spark):
    """Steps one after another: their files do not add up."""
    files = lambda: spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ").count(".data")
    free_shuffles(spark)
    before, after = files(), []
    base = cut_lineage(spark.range(1000).selectExpr("id % 8 AS g", "id"))
    for _ in range(5):
        cut_lineage(base.groupBy("g").applyInArrow(lambda t: t, "g long, id long"))
        made = files()
        free_shuffles(spark)
        after.append((made, files()))
    one = max(1, after[0][0] - before)
    assert after[-1][1] <= before + 2 * one
