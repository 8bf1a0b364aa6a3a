"""What the rows of the advertiser feed carry when they are dealt to their file."""
import re

from feedspark.plans import landing as L
from tests.test_landing import tables  # noqa: F401


def test_an_order_is_dealt_once_with_its_brands(spark, tables):  # noqa: F811
    docs = L.advertiser_documents(L.read_tables(spark, tables))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    dealt = next(line for line in plan.split("\n") if "RepartitionByExpression" in line)
    below = plan[plan.index(dealt) :].split("\n")[1:]
    output = next(line for line in below if "Aggregate" in line)
    assert "of_order" in output and re.search(r"Aggregate \[o_orderkey", output)
    assert "o_orderpriority" not in output
