"""The stages of the pipeline on small tables with planted near copies."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from itertools import combinations

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from grainmill.llm import mixing, pii, pu_quality


def shingles(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def similar(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) >= 0.8 * len(x | y)


def planted(groups=40, seed=5):
    """(doc_id, text): an original and three copies with some words changed, a chain, and strangers."""
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(5000)}"
    texts = []
    for g in range(groups):
        base = [word() for _ in range(draw.randrange(60, 300))]
        texts.append(base)
        for part in (0.003, 0.008, 0.02):
            copy = list(base)
            for i in draw.sample(range(len(copy)), max(1, int(part * len(copy)))):
                copy[i] = word()
            texts.append(copy)
        texts.append([word() for _ in range(20)])
    draw.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def brute_kept(rows):
    up = {i: i for i, _ in rows}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (i, a), (j, b) in combinations(rows, 2):
        if similar(a, b):
            x, y = sorted((top(i), top(j)))
            up[y] = x
    return {i for i in up if top(i) == i}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}") for i, t in rows], "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("bound", [2, 64])
def test_near_dedup_matches_brute_force(spark, bound):
    rows = [*planted(), (900, None), (901, " "), (902, "Two words"), (903, "two  words")]
    found = corpus_pipeline.near_copies.near_copies(documents(spark, rows), pair_bound=bound).where("kept").collect()
    assert {r["id"] for r in found} == brute_kept(rows)


def test_the_dedup_stage_matches_brute_force(spark):
    rows = planted()
    left = corpus_pipeline.simhash_near_dedup(spark, documents(spark, rows), "").collect()
    assert sorted(r["doc_id"] for r in left) == sorted(brute_kept(rows))


def test_a_repeated_id_loses_no_text_of_its_own(spark):
    other, copy, alone = (" ".join(f"{k}{i}" for i in range(100)) for k in "abc")
    rows = [(1, other), (7, other + " more"), (7, alone), (7, alone), (7, copy), (None, copy)]
    left = corpus_pipeline.simhash_near_dedup(spark, documents(spark, rows), "").collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == sorted([(1, other), (7, alone), (7, copy), (0, copy)])


def corpus(seed=9):
    """Good and bad prose, near copies, personal data, odd rows, and columns that clash with those of the operators."""
    draw = random.Random(seed)
    word = lambda: f"{draw.choice('bcdfglmn')}{draw.choice('aeiou')}{draw.choice('rstln')}{draw.choice('aeiou')}{draw.randrange(40)}"
    texts = []
    for k in range(240):
        words = [word() for _ in range(draw.randrange(40, 160))]
        if k % 4 == 3:
            words = [f"{w.upper()}!!" for w in words]
        elif k % 9 == 1:
            words[5:5] = ["a.b@c-d.org", "and", "10.0.0.1"]
        texts.append(" ".join(words) + ("" if k % 4 == 3 else "."))
        if k % 10 == 0:
            texts.append(" ".join([*words[:-1], "other"]) + ".")
    rows = [(i, t, i % 4 != 3) for i, t in enumerate(texts)]
    return rows + [(5, texts[5], True), (6, texts[8], True), (None, texts[0], True), (9000, None, None), (9001, "", None), (None, None, None)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, features string, class long, _text string, kept string"


def tables(spark, path, rows):
    full = [(i, t, "en" if k % 3 else None, f"s{k % 2}", None if t is None else len(t), k, "r", "f", 1, "t", "k") for k, (i, t, _) in enumerate(rows)]
    spark.createDataFrame(full, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    marks = sorted({(i, int(not t.endswith("!!"))) for i, t, good in rows if i is not None and good is not None and i % 3 == 0 and t})
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")


def masked(text, spans):
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{pii.KINDS[s['kind']].upper()}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def test_the_pipeline_matches_its_stages_by_brute_force(spark, tmp_path):
    """run() against stages in memory: scores and spans come from the operators, all decisions are made here."""
    sf = str(tmp_path)
    tables(spark, sf, corpus())
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = docs.collect()
    model = pu_quality.train(pu_quality.feature_table(docs), labels)
    good = [r for r in rows if model.score(np.array([pu_quality.features(r["text"])], dtype=np.float32).astype(float))[0] >= 0.3]
    assert 0 < len(good) < len(rows)

    named, nodes = [r for r in good if r["doc_id"] is not None], {}
    for r in named:
        nodes.setdefault((r["doc_id"], tuple((r["text"] or "").lower().split())), r)
    up = {k: k for k in nodes}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in combinations(sorted(nodes), 2):
        if similar(nodes[a]["text"], nodes[b]["text"]):
            x, y = sorted((top(a), top(b)))
            up[y] = x
    least = {}
    for k in nodes:
        least[top(k)] = min(least.get(top(k), k), k)
    kept = [nodes[k] for k in least.values()] + [r for r in good if r["doc_id"] is None]
    assert len(kept) < len(good)

    table = spark.createDataFrame([(k, r["text"]) for k, r in enumerate(kept)], "doc_id long, text string")
    spans = {r["id"]: r["spans"] for r in pii.detect(table).collect()}
    clean = [(r, None if r["text"] is None else masked(r["text"], spans[k])) for k, r in enumerate(kept)]
    assert any("<EMAIL>" in (t or "") for _, t in clean)

    topic = {r["i"]: r["topic"] for r in spark.createDataFrame(list(enumerate(t or "" for _, t in clean)), "i int, t string").select("i", mixing.surface_topic(F.col("t")).alias("topic")).collect()}
    cell = lambda k: (clean[k][0]["source"], clean[k][0]["lang"], topic[k])
    tokens = {}
    for k, (_, t) in enumerate(clean):
        tokens[cell(k)] = tokens.get(cell(k), 0) + len((t or "").split())
    along = [{} for _ in range(3)]
    for c, n in tokens.items():
        for d in range(3):
            along[d][c[d]] = along[d].get(c[d], 0) + n
    weights = mixing.rake(tokens, [mixing.tempered(a, 1.0 if d == 2 else corpus_pipeline.MIX_TEMPER) for d, a in enumerate(along)])
    chance = mixing.calibrate(tokens, {c: weights.get(c, 0.0) / n if n else 1.0 for c, n in tokens.items()}, corpus_pipeline.MIX_SHARE)
    drawn = lambda i: int(hashlib.md5(f"7:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) / (1 << 52)
    mixed = [(r["doc_id"], t) for k, (r, t) in enumerate(clean) if drawn(r["doc_id"]) < chance[cell(k)]]
    assert 0 < len(mixed) < len(clean)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((i, tuple(library.encode(t or ""))) for i, t in mixed)
    assert Counter((r["doc_id"], tuple(r["ids"] or ())) for r in corpus_pipeline.run(spark, sf).collect()) == want


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    tables(spark, sf, corpus()[:40])
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf)
        assert out.count() == 0, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == empty.columns, name
