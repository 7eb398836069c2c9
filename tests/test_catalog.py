"""The module of registered queries: names, and queries that the default selection leaves out."""

import ast
from collections import Counter

import __spark_entry__ as entry
import compare
import pytest

from faultline.operators import audit
from faultline.plans import catalog, metrics


def test_no_function_replaces_another():
    with open(catalog.__file__) as source:
        names = Counter(n.name for n in ast.parse(source.read()).body if isinstance(n, ast.FunctionDef))
    assert [n for n, times in names.items() if times > 1] == []


@pytest.mark.parametrize("name", ["upsert_first_wins", "upsert_last_wins"])
def test_replayed_orders_equal_sql(spark, sf, name):
    con = compare.connect(sf)
    verdict, rows, _, detail = compare.compare(spark, con, sf, name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict == "equal" and rows > 0, detail


def test_orders_are_judged_once_for_the_cut(spark):
    """The range of the scores is measured on stored counts, not by judging all orders again."""
    judged = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            judged.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(n / 10, n > 4) for n in range(10)], "score DOUBLE, covered BOOLEAN")
    cut = audit.calibrate(rows.mapInArrow(counted, rows.schema)).first()
    assert (cut.cut, cut.caught, cut.flagged) == (0.5, 5, 0)
    assert judged.value == 10
    values = metrics.percentiles(rows.mapInArrow(counted, rows.schema), "score", p50=0.5).first()
    assert abs(values.p50 - 0.45) < 1e-12 and judged.value == 20
