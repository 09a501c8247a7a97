"""Driver contract: entry() runs, every oracle key is a query, cheap oracles agree."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.check_oracle import compare, duck_connection

CHEAP = ["corpus_report", "read_jsonl_cleaner", "round_numbers", "sort_attributes", "preset_choose",
         "split_exact", "word_histogram", "trace_runs", "ssim_tiles"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "n_rows" in df.columns


def test_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50


@pytest.mark.parametrize("name", CHEAP)
def test_oracle_small(spark, name):
    con = duck_connection(SF001)
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert res["status"] == "ok", res
