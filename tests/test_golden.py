"""Row counts of the layers that were worked out independently of this code."""

import pytest
from conftest import SF_MEDIUM, SF_SMALL
from pyspark.sql import functions as F

from basketry.operators import quality as Q, scd2
from basketry.plans import bronze, rules as R, silver
from basketry.sources.testtables import FIRST_BY, TIEBREAK_EXTRA, raw_with_audit, table

COUNTS = {
    SF_SMALL: dict(raw=6000, bronze=1156, null_id=319, quantity=4525, both=253, discount=150,
                   profit=45, unlisted=125, orders=646, dedup_first=591, warn=313,
                   versions=802, current=15),
    SF_MEDIUM: dict(raw=60000, bronze=11582, null_id=2841, quantity=45577, both=2244, discount=1723,
                    profit=523, unlisted=1137, orders=6356, dedup_first=5862, warn=3067,
                    versions=8016, current=150),
}


@pytest.mark.parametrize("sf", list(COUNTS))
def test_layer_counts(spark, sf):
    want = COUNTS[sf]
    raw = raw_with_audit(spark, sf)
    tagged = bronze.tagged(raw)
    accepted = Q.accepted(tagged)
    got = {"raw": raw.count(), "bronze": accepted.count()}

    bad = bronze.quarantine(tagged)
    reasons = dict(bad.groupBy("_failure_reason").count().collect())
    got["null_id"] = reasons["order_id IS NULL"]
    got["quantity"] = reasons["quantity out of range [1, 10]"]
    got["both"] = bad.filter(F.size(Q.VIOLATIONS) == 2).count()

    listed = dict(silver.quarantine(accepted, complete=False).groupBy("failure_reason").count()
                  .collect())
    got["discount"] = listed["discount out of range [0.0, 0.5]"]
    got["profit"] = listed["profit IS NULL"]
    got["unlisted"] = silver.quarantine(accepted).count() - sum(listed.values())

    orders = silver.orders(accepted, FIRST_BY, TIEBREAK_EXTRA)
    got["orders"] = orders.count()
    got["dedup_first"] = silver.orders(accepted, FIRST_BY, TIEBREAK_EXTRA, dedup_first=True).count()
    rule = [r for r in R.ORDER_WARN_RULES if r.name == "ship_after_order"]
    got["warn"] = Q.report(orders, rule, "orders").first()["failed"]

    history = scd2.versions(table(spark, sf, "events"), ["user_id"], "ts", ["user_id", "event_type"])
    got["versions"] = history.count()
    got["current"] = scd2.current(history).count()
    assert got == want
