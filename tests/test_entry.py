"""Driver contract: smoke entry and every registered query against its oracle."""

import ast
import pathlib

import pytest

import __spark_entry__ as entry
from cardwatch.plans.catalog import QUERIES
from tests.oracle_check import compare

ROOT = pathlib.Path(__file__).resolve().parent.parent


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "alert_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def report(spark, sf_dir):
    return compare(spark, sf_dir, list(QUERIES))


def test_queries_match_oracle(report):
    bad = {k: v for k, v in report.items()
           if "error" in v or (("values" in v) and not (v["values"] and v["schema"]))}
    assert not bad, bad


def test_no_collect_in_library_data_path():
    """The data path never pulls rows to the driver."""
    offenders = []
    for path in (ROOT / "cardwatch").rglob("*.py"):
        if "llm" in path.relative_to(ROOT).parts:     # fits models on the driver, see there
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            if isinstance(node, ast.Attribute) and node.attr in ("collect", "toPandas",
                                                                "toLocalIterator"):
                offenders.append(f"{path.name}:{node.lineno}")
    assert not offenders, offenders
