"""Shape of the physical plans."""

import re
import sys

import pytest

from catalog import QUERIES
from check import TABLES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "MapInPandas", "FlatMapGroups"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """What ran, with reused parts named and not repeated."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", ["installment_summary", "assign_invoice", "item_summary",
                                  "goal_metrics", "collections_bank", "classify_advance",
                                  "flag_advances", "bureau_a", "monthly_base"])
def test_no_python_and_no_pairs(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not [word for word in FORBIDDEN if word in plan]


def test_summary_reads_only_its_columns_and_shuffles_once(spark):
    plan = plan_of(QUERIES["installment_summary"](spark, SF))
    assert "l_discount" not in plan and "l_returnflag" not in plan
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan and "partial_min_by" in plan


def test_filter_reaches_the_scan(spark):
    plan = QUERIES["collections_bank"](spark, SF)._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in plan


# These write files as part of what they show.
WRITERS = {"record_file_read", "load_many_files", "publish_report", "monthly_base_counts"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_building_a_query_runs_no_job(spark, monkeypatch, name):
    """But reading schemas, and writing tables that several outputs share."""
    read = {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in TABLES}
    for module in [m for n, m in list(sys.modules.items()) if n.startswith(("catalog", "ledgerspark"))]:
        if hasattr(module, "table") and module.__name__.startswith("catalog"):
            monkeypatch.setattr(module, "table", lambda spark, d, t: read[t])
        if hasattr(module, "written"):
            monkeypatch.setattr(module, "written", lambda df: df)
    spark.sparkContext.setJobGroup(name, name)
    QUERIES[name](spark, SF)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(name)


def test_repeats_are_flagged_with_two_scans(spark):
    df = QUERIES["dup_flag"](spark, SF)
    df.collect()
    scans = re.findall(r"\bScan parquet", final_plan(df))
    assert len(scans) <= 2


def test_windows_only_along_a_calendar(spark):
    """The one window runs over client days; repeats are flagged without one."""
    assert plan_of(QUERIES["assign_invoice"](spark, SF)).count("Window [") == 1
    assert "Window" not in plan_of(QUERIES["dup_flag"](spark, SF))


def test_monthly_base_frees_what_it_has_used(spark, monkeypatch):
    """Sales, reduced tables and earlier placements are gone once the report is placed."""
    plan = sys.modules["ledgerspark.plans.monthly_base"]

    tables, real = [], plan.written
    monkeypatch.setattr(plan, "written", lambda df: tables.append(real(df)) or tables[-1])
    report = QUERIES["monthly_base"](spark, SF)
    assert report.count() > 0
    wide = [t for t in tables if "Credito" in t.columns]
    assert len(wide) >= 8 and wide[-1].count() > 0
    assert all(spark.read.schema(t.schema).parquet(t.written_to).isEmpty() for t in wide[:-1])
