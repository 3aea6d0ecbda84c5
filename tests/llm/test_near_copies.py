"""Near copies against all pairs: no link is left out, and few pairs of a large group are verified."""

from __future__ import annotations

import random
import subprocess
import sys
from itertools import combinations
from pathlib import Path

import pytest

from grainmill.llm import near_copies


def shingles(text, n=5):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def brute_kept(rows, least):
    up, sets = {i: i for i, _ in rows}, {i: shingles(t) for i, t in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, _), (j, _) in combinations(rows, 2):
        if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
            x, y = sorted((top(i), top(j)))
            up[y] = x
    return {i for i in up if top(i) == i}


def straddling(n, words, edits, seed):
    """(doc_id, text): copies of one text with up to so many words changed, many of them near the threshold."""
    draw = random.Random(seed)
    base, rows = [f"w{draw.randrange(5000)}" for _ in range(words)], []
    for k in range(n):
        copy = list(base)
        for i in draw.sample(range(words), draw.randrange(edits + 1)):
            copy[i] = f"x{draw.randrange(3)}"
        rows.append((k, " ".join(copy)))
    return rows


def kept(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["id"] for r in near_copies.near_copies(docs, **more).where("kept").collect()}


@pytest.mark.parametrize("least", [0.5, 0.9])
def test_no_link_is_left_out_at_other_thresholds(spark, least):
    rows = [(10 * k + i, t) for k in range(20) for i, t in straddling(9, 60, 9, k)]
    assert kept(spark, rows, least=least) == brute_kept(rows, least)


def test_a_group_around_the_threshold_is_whole_and_few_of_its_pairs_are_verified(spark, monkeypatch):
    rows, counts = straddling(300, 80, 9, 3), []
    verify = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *rest: counts.append(pairs.count()) or verify(pairs, *rest))
    expected = brute_kept(rows, 0.8)
    assert kept(spark, rows) == expected and len(expected) > 50
    assert sum(counts) < 0.1 * len(rows) * (len(rows) - 1) / 2


def test_sets_of_some_thousand_shingles_are_left_out_before_they_are_moved(spark, monkeypatch):
    draw, counts = random.Random(2), []
    words = lambda n: [f"w{draw.randrange(50000)}" for _ in range(n)]
    base = words(2500)
    rows = [(i, " ".join(base + words(540))) for i in range(12)] + [(20 + i, " ".join(base + words(40))) for i in range(4)]
    verify = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda pairs, *rest: counts.append(pairs.count()) or verify(pairs, *rest))
    expected = brute_kept(rows, 0.8)
    assert kept(spark, rows) == expected and len(expected) < len(rows)
    assert sum(counts) < 60


def test_sets_are_worked_out_for_members_only(spark):
    rows = [(i, f"a b c d e f g {i % 500}") for i in range(2000)] + [(7, "another text of the same id")]
    chosen = spark.createDataFrame(rows, "id long, text string")
    texts = {near_copies.class_of(t): t for i, t in rows if i in (3, 7, 1999)}
    members = spark.createDataFrame([(near_copies.class_of(t), i) for i, t in rows if i in (3, 7, 1999)], "class long, id long")
    assert near_copies._flagged_sets(chosen, near_copies._flags(members)).count() < 20
    sets = {r["class"]: len(r["shingles"]) for r in near_copies.shingle_sets(chosen, members).collect()}
    assert sets == {c: len(shingles(t)) for c, t in texts.items()} and len(sets) == 4


def test_a_worker_gives_the_memory_of_dropped_caches_back():
    code = """
from pathlib import Path
import pyarrow
from grainmill.llm.common import worker_cache
mb = lambda: sum(int(x.split()[1]) for x in Path("/proc/self/smaps_rollup").read_text().splitlines() if x.startswith("Pss_Anon")) / 1024
worker_cache("many")["x"] = [bytes(4000) for _ in range(50000)]
pin, full = [bytes(4000) for _ in range(9)], mb()
worker_cache()
print(full - mb())
"""
    if not Path("/proc/self/smaps_rollup").exists():
        pytest.skip("memory can't be read here")
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, check=True)
    assert float(said.stdout) > 150
