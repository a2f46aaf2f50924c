"""Every registered query against its DuckDB oracle (order-insensitive, 6-digit floats).

Runs at sf0.001 by default; set CG_ORACLE_SF=/root/testdata/sf0.01 for the driver's scale.
"""

import os
import re

import pytest

import __spark_entry__ as E
import oracle_harness as H
from commentguard.operators import splits as SP
from commentguard.plans import fixtures as FX

SF = os.environ.get("CG_ORACLE_SF", "/root/testdata/sf0.001")
LLM = re.compile(r"op\d+_|pipeline$")  # tested in tests/llm
SQL = {k: v for k, v in E.oracle_sql().items() if not LLM.match(k)}


@pytest.fixture(scope="module")
def con():
    return H.duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    n, diff = H.compare(df, con, SQL[name])
    assert not diff, diff[:2]


@pytest.mark.parametrize("name,domain", [("q_fit_levels", range(4)), ("q_fit_types", range(2)), ("q_fit_svm", range(2)), ("q_fit_head", range(10))])
def test_fits_predict_the_test_split(spark, name, domain):
    rows = [r.asDict() for r in E.queries()[name](spark, SF).collect()]
    base = FX.document_logits(spark, SF).select("id")
    if name == "q_fit_head":
        base = FX.table(spark, SF, "embeddings").selectExpr("vec_id AS id")
    if name == "q_fit_svm":
        base = FX.table(spark, SF, "labels").selectExpr("doc_id AS id")
    want = {r["id"] for r in SP.split(base, "id").filter("split = 'test'").collect()}
    assert rows and len(rows) == len(want) and {r["id"] for r in rows} == want
    for r in rows:
        values = r["pred"] if "pred" in r else [r[c] for c in r if c.startswith("p_") or c == "predicted"]
        assert values and all(v in domain for v in values)


def test_handed_over_model_reports(spark):
    rows = E.queries()["q_fit_report"](spark, SF).collect()
    assert {r["task"] for r in rows} == {"ind", "grp", "soc"}
    assert all(0 <= r["f1"] <= 1 for r in rows if r["f1"] is not None)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["id", "cmt", "cmt_processed"]
    assert df.count() > 0
