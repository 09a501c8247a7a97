"""Plan shape: pruning, push-down, broadcast of bounded sides, exchange counts."""

import __spark_entry__ as E
from loomkit.operators import select as S
from tests.conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_is_narrow_until_the_report(spark):
    p = plan(E.entry(spark))
    assert p.count("Exchange hashpartitioning") == 1          # only the final per-source aggregate
    assert "BroadcastExchange" in p                            # the size-checked markup side
    assert "LessThan(p_partkey" not in p                       # every part row is used
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in p


def test_preset_grid_has_no_join(spark):
    imgs = spark.range(5).withColumnRenamed("id", "image_id")
    p = plan(S.with_presets(imgs))
    assert "Join" not in p and "Exchange" not in p


def test_candidate_choice_shuffles_once_by_image(spark):
    p = plan(E.queries()["preset_choose"](spark, SF001))
    assert p.count("Exchange hashpartitioning(image_id") == 1  # window and aggregate share it
