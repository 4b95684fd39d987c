from __future__ import annotations

import pytest
from conftest import plan, rows

from tidemark.operators.measures import Dimension, Entity, Measure, SemanticModel, measure

ORDERS = SemanticModel(
    name="orders",
    entities=(Entity("order", "id", primary=True), Entity("customer", "customer_id")),
    dimensions=(Dimension("placed", "at", is_time=True), Dimension("state", "state")),
    measures=(
        Measure("total", "sum", "amount"),
        Measure("n", "count", "amount"),
        Measure("mean", "average", "amount"),
        Measure("open_total", "sum", "amount", where="state = 'open'"),
        Measure("states", "count_distinct", "state"),
    ),
)
CUSTOMERS = SemanticModel(
    name="customers",
    entities=(Entity("customer", "id", primary=True),),
    dimensions=(Dimension("segment", "segment"),),
)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.sql(
        """
        select * from values
            (1, 1, date'2024-01-01', 'open', 10), (2, 1, date'2024-01-31', 'done', 20),
            (3, 2, date'2024-02-01', 'open', 5), (4, 9, date'2024-02-02', 'done', null),
            (5, null, date'2024-02-03', 'done', 7)
        as t(id, customer_id, at, state, amount)
        """
    )


@pytest.fixture(scope="module")
def related(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, segment string")
    return {"customer": (CUSTOMERS, customers)}


def test_totals(orders):
    names = [m.name for m in ORDERS.measures]
    assert rows(measure(ORDERS, orders, names), *names) == [(42, 4, 10.5, 15, 2)]


def test_grain(orders):
    found = measure(ORDERS, orders, ["total"], ["placed__month"])
    assert [r[1] for r in rows(found)] == [30, 12]


@pytest.mark.parametrize("names", [["total", "n", "mean", "open_total"], ["states", "total"]])
def test_dimension_of_another_model(orders, related, names):
    found = measure(ORDERS, orders, names, ["customer__segment"], related)
    by_segment = {r["customer__segment"]: r for r in found.collect()}
    assert set(by_segment) == {"a", "b", None}
    assert by_segment["a"]["total"] == 30 and by_segment[None]["total"] == 7
    if "mean" in names:
        assert by_segment["a"]["mean"] == 15.0 and by_segment["a"]["open_total"] == 10
        assert by_segment[None]["n"] == 1


def test_facts_are_summed_before_the_join(orders, related):
    text = plan(measure(ORDERS, orders, ["total"], ["customer__segment"], related))
    below_join = text[text.index("Join") :]
    assert "partial_sum" in below_join


def test_sketches_of_days_roll_up_to_coarser_grains(spark):
    from tidemark.operators.measures import Dimension, Measure, SemanticModel, distinct_sketches, measure, rolled_up

    model = SemanticModel(
        "m",
        dimensions=[Dimension("day", "d", is_time=True), Dimension("kind", "k")],
        measures=[Measure("n", "count_distinct", "v"), Measure("n_odd", "count_distinct", "v", "v % 2 = 1"), Measure("s", "sum", "v")],
    )
    df = spark.range(30_000).selectExpr("date_add(date'2024-01-29', cast(id % 9 as int)) AS d", "if(id % 3 = 0, null, 'a') AS k", "id % 7000 AS v")
    sketches = distinct_sketches(model, df, ["n", "n_odd"], "day", ["kind"])
    assert sketches.count() == 9  # a day's ids have one remainder by 3, so one kind
    for grain in ("week", "month", "quarter"):
        exact = {(r[0], r.kind): (r.n, r.n_odd) for r in measure(model, df, ["n", "n_odd"], [f"day__{grain}", "kind"]).collect()}
        about = {(r[0], r.kind): (r.n, r.n_odd) for r in rolled_up(sketches, ["n", "n_odd"], "day", grain, ["kind"]).collect()}
        assert exact.keys() == about.keys()
        assert all(abs(a - e) <= 0.05 * e for key in exact for a, e in zip(about[key], exact[key]))
    none = distinct_sketches(model, df.filter("k = 'a'"), ["n_odd"], "day", ["kind"])
    assert none.filter("kind IS NULL").count() == 0
    import pytest

    with pytest.raises(ValueError):
        distinct_sketches(model, df, ["s"], "day")
