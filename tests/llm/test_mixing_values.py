"""Raking keeps the marginal of every value, however many a dimension has."""

from __future__ import annotations

import pytest

from grainmill.llm import mixing


@pytest.mark.parametrize("targets", [None, {"source": {"s9": 0.5, "s10": 0.3, "s11": 0.2}}])
def test_small_sources_keep_their_own_targets(spark, targets):
    rows = [(i, "w " * (1 + i % 7) * (12 - i % 12), f"s{i % 12}", ("en", "fr")[i % 5 == 0]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    few, many = (
        {r["row"]["doc_id"]: r for r in mixing.mix(docs, targets=targets, share=0.1, max_values=m).collect()} for m in (4, 256)
    )
    assert few.keys() == many.keys()
    for i, r in few.items():
        assert r["weight"] == pytest.approx(many[i]["weight"], rel=1e-6, abs=1e-9)
        assert r["probability"] == pytest.approx(many[i]["probability"], rel=1e-6, abs=1e-9)
    if targets:
        sums = {}
        for r in few.values():
            sums[r["source"]] = sums.get(r["source"], 0) + r["n_tokens"] * r["weight"]
        whole = sum(sums.values())
        assert {s: pytest.approx(v / whole, abs=1e-6) for s, v in sums.items() if v} == targets["source"]
