"""Plan review: no Python evaluation or cartesian products; text stays out of shuffles."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from veracity.plans.oracle import ORACLE

SQL_KEYS = sorted(ORACLE)


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", SQL_KEYS)
def test_no_python_nodes_or_cartesian(spark, key):
    plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"EvalPython|PythonUDF|InPandas|CartesianProduct", plan), key


@pytest.mark.parametrize("key", ["fraud_scores", "overall_summary", "suspicious_reviewers", "feature_table",
                                 "stratified_split", "label_noise", "balanced_counts"])
def test_review_text_never_shuffled(spark, key):
    text = _formatted(entry.queries()[key](spark, SF_SMALL))
    blocks = re.findall(r"\(\d+\) (?:Exchange|BroadcastExchange)\nInput \[\d+\]: \[([^\]]*)\]", text)
    assert blocks, key
    # The documents table (text) may be broadcast by the stand-in input; the
    # review rows themselves never enter an exchange together with the body.
    for cols in blocks:
        assert not ("body" in cols and "review_id" in cols), (key, cols)
