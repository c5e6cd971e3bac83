"""Physical-plan properties that matter at scale (read from ``explain``)."""

import contextlib
import io

import pytest

from reviewlake.plans import queries as Q

BASE = "/root/testdata/sf0.001"


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_range_scan_pushes_filter_and_prunes_columns(spark):
    p = plan(Q.range_scan(spark, BASE))
    assert f"GreaterThanOrEqual(o_orderkey,{Q.RANGE_START_KEY})" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in p
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", ["label_counts", "clean_collapse", "title_repair", "html_text", "tfidf",
                                  "product_document", "overview_document", "merge_upsert"])
def test_no_python_in_native_queries(spark, name):
    p = plan(getattr(Q, name)(spark, BASE))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)


@pytest.mark.parametrize("name", ["similar_tfidf", "similar_documents"])
def test_sparse_join_is_native(spark, name):
    p = plan(getattr(Q, name)(spark, BASE))
    for bad in ("InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, (name, bad)
    assert "WindowGroupLimit" in p


@pytest.mark.parametrize("name", ["knn_l2", "cosine_topk"])
def test_blocked_search_has_no_cartesian(spark, name):
    p = plan(getattr(Q, name)(spark, BASE))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "FlatMapGroupsInPandas" in p
    assert "WindowGroupLimit" in p          # partial top-k before the final shuffle


def test_last_per_key_is_partial_aggregate(spark):
    p = plan(Q.upsert_latest(spark, BASE))
    assert p.count("HashAggregate") + p.count("ObjectHashAggregate") + p.count("SortAggregate") >= 2
    assert "Window" not in p
