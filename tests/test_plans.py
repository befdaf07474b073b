"""Physical plans hold what large tables need."""

import pytest

import __spark_entry__ as entry


def plan(spark, sf, name):
    return entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["p1_dedupe_keep_first", "w2_first_per_text", "w3_top_k_per_group"])
def test_top_k_is_cut_before_the_shuffle(spark, sf, name):
    text = plan(spark, sf, name)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scan_reads_only_what_is_used(spark, sf):
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan(spark, sf, "a11_hits_by_quarter")


@pytest.mark.parametrize("name", ["a4_group_sizes", "a12_success_prior", "w1_group_totals", "m3_stratified_split", "t8_seeded_sample"])
def test_no_nested_loops(spark, sf, name):
    text = plan(spark, sf, name)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_group_totals_use_no_window(spark, sf):
    assert "Window" not in plan(spark, sf, "w1_group_totals")
