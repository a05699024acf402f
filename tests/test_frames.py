"""Merchant windows by range frames: equal to the form that expands panes, over gaps, ranges and slides."""

import random
import re

import pytest

from conftest import SF_SMALL
from helpers import prepared, sorted_rows
from txlens.operators import merchant_window_aggregates
from txlens.operators.aggregates import merchant_window_aggregates_by_frames
from txlens.plans import batch
from txlens.schema import MERCHANT_AGG_COLUMNS


def _rows(seed, n=400, spread=40_000):
    r = random.Random(seed)
    amounts = [0.25, 1.5, 20.0, 2.0**40, float("nan"), float("inf")]
    start = 1_704_067_200 - 17  # around midnight, so that ranges and panes are cut
    return [
        {
            "transaction_id": str(i),
            "user_id": r.choice(["a", "b", "c", None]),
            "merchant": r.choice(["m", "m", "n", None]),
            "currency": r.choice(["USD", "EUR", None]),
            "amount": r.choice(amounts),
            "transaction_time": r.choice([None, start + r.randrange(spread), start + r.randrange(300), -r.randrange(2000)]),
        }
        for i in range(n)
    ]


@pytest.mark.parametrize(
    "window, slide, range_slides",
    [("5 minutes", "1 minute", 1), ("5 minutes", "1 minute", 256), ("5 minutes", "2 minutes", 3), ("10 minutes", "10 minutes", 2), ("3 minutes", "5 minutes", 2), ("7 minutes", "3 minutes", 4)],
)
def test_frames_equal_the_expanded_form(spark, window, slide, range_slides):
    tx = prepared(spark, _rows(len(window) * range_slides))
    found = merchant_window_aggregates_by_frames(tx, window, slide, range_slides=range_slides)
    want = merchant_window_aggregates(tx, window, slide)
    assert found.columns == want.columns
    rows = sorted_rows(want, *MERCHANT_AGG_COLUMNS)
    assert rows and sorted_rows(found, *MERCHANT_AGG_COLUMNS) == rows


def test_no_rows(spark):
    assert merchant_window_aggregates_by_frames(prepared(spark, _rows(1, 5)).limit(0)).count() == 0


def test_a_merchant_is_many_tasks_and_panes_are_not_copied_to_windows(spark):
    tx = batch.transactions(spark, SF_SMALL)
    found = merchant_window_aggregates_by_frames(tx, range_slides=8)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert "specifiedwindowframe(RangeFrame, currentrow$(), 240)" in final
    assert re.search(r"Exchange hashpartitioning\(merchant#\d+, _range#\d+L", final)
    # nothing is shuffled between the starts put in and their frames, and the next range's copies are the same shuffled panes
    frames, starts = final.index("RangeFrame"), final.index("Generate explode(array_union")
    assert frames < starts and "Exchange" not in final[frames:starts]
    assert "ReusedExchange" in final
