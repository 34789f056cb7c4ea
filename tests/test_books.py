"""Order-book statistics on hand-made documents (empty sides, NULL books,
one level, missing sizes, zero weights)."""

import json

import numpy as np

from marketlake.operators import books as B


def books(spark, docs):
    return spark.createDataFrame([(i, None if d is None else json.dumps(d)) for i, d in enumerate(docs)],
                                 "market_id long, orderbook string")


DOCS = [
    {"yes_dollars": [["0.51", "15.00"], ["0.50", "5"]], "no_dollars": [["0.45", "10"]]},
    {"yes_dollars": [], "no_dollars": None},
    None,
    {"yes_dollars": [["0.40", "3"]], "no_dollars": []},
    {"yes_dollars": [["0.40"]], "no_dollars": [["0.30", "0"]]},
]


def test_depth(spark):
    got = {r.market_id: r for r in B.orderbook_depth(books(spark, DOCS)).collect()}
    assert got[0].orderbook_total_depth_contracts == 30.0 and got[0].best_yes_bid == 0.51
    assert got[1].orderbook_yes_depth_contracts == 0.0 and got[1].best_yes_bid is None
    assert got[2].orderbook_yes_depth_contracts is None
    # a level without a size counts toward the best bid but not the depth
    assert got[4].orderbook_yes_depth_contracts == 0.0 and got[4].best_yes_bid == 0.40


def test_implied_std(spark):
    got = {r.market_id: r.orderbook_yes_implied_std for r in B.orderbook_implied_std(books(spark, DOCS)).collect()}
    p, w = np.array([0.51, 0.50, 0.55]), np.array([15.0, 5.0, 10.0])
    m = np.average(p, weights=w)
    assert abs(got[0] - np.sqrt(np.average((p - m) ** 2, weights=w))) < 1e-12
    assert got[1] is None and got[2] is None
    assert got[3] == 0.0
    # sizes 1 (absent) and 0 -> weighted with total weight 1: all weight on 0.40
    assert abs(got[4]) < 1e-12


def test_levels_and_nonempty(spark):
    b = books(spark, DOCS)
    lv = {r.market_id: (r.yes_levels, r.no_levels) for r in B.orderbook_levels(b).collect()}
    assert lv[0] == (2, 1) and lv[1] == (0, 0)
    assert sorted(r.market_id for r in B.nonempty_books(b).collect()) == [0, 3, 4]
