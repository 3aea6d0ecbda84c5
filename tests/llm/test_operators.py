"""The operators against brute force, and their defined cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from grainmill.llm import lm_score, mixing, pieces, pii, pu_quality, quality_rules, sharding, simhash, token_files, vector_dedup
from grainmill.llm.common import load

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names clash with those that operators use inside.
EXTRA = "id long, words string, n long, base string, fp long, kept string, _text string, row string, y int, features string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def table(spark, rows):
    """Rows of (doc_id, text), with every other column null in turn."""
    full = [(i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 4 else None, None if t is None else len(t), k, "w", 1, "b", 2, "k", "t", "r", 1, "f") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"word{i % 977} and, more {i}" for i in range(60_000))
ODD = [None, "", " ", "\n\n", "a", "a b", "A b\x0bc", "é ß ▁ 漢字", "x" * 5000, "one two three " * 40, "Tab\tand nbsp", "<|endoftext|> twice <|endoftext|>", "  lead and  double  ", "mail a@b.co now", LONG]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a repeated row, a repeated id and null ids."""
    rows = [*enumerate(ODD), (4, "a"), (5, "another text"), (None, "no id"), (None, None)]
    return table(spark, rows).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(9, 1, 0), (14, 1, 0), (3, 0, 0), (3, 1, 0), (None, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")


def rows_of(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


# ---------------------------------------------------------------- 1: vectors
def brute_vectors(rows, cosine=0.98):
    good = {}
    for k, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            a = np.array(v, dtype=np.float64)
            a = a / np.abs(a).max()
            good[k] = a / np.linalg.norm(a)
    links = {k: [j for j in good if j != k and rows[j][2] == rows[k][2] and len(good[j]) == len(good[k]) and good[j] @ good[k] >= cosine] for k in good}
    same = {}
    for k, (i, *_) in enumerate(rows):
        same.setdefault(i, []).append(k)
    out = Counter()
    for k, (i, *_) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            x = todo.pop()
            for y in [*links.get(x, []), *(same[rows[x][0]] if x in good and rows[x][0] is not None else [])]:
                if y not in seen and y in good:
                    seen.add(y)
                    todo.append(y)
        low = None if i is None else min(rows[x][0] for x in seen)
        out[i, len(links.get(k, [])), low, low == i and i is not None] += 1
    return out


def vector_rows(n=400, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(k, [float(x) for x in centres[k % 12] + rng.normal(size=dim) * rng.choice([0.02, 0.1, 0.4])], int(k % 3)) for k in range(n)]
    rows += [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * dim, 1), (n + 3, [1.0, None] + [0.0] * (dim - 2), 1), (n + 4, [float("nan")] * dim, 1), (n + 5, rows[0][1], None), (None, rows[0][1], 0), (n + 6, rows[0][1][:3], 0), (n + 7, rows[0][1], 0), (n + 8, [1e200, 1e200, 0.0, 0.0, 0.0, 0.0], 2), (n + 9, [1e-200, 1e-200, 0.0, 0.0, 0.0, 0.0], 2)]
    return rows


@pytest.mark.parametrize("sizes", [{"cell_rows": 1000, "block_rows": 2048}, {"cell_rows": 20, "block_rows": 16}])
def test_vectors_match_brute_force(spark, sizes):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, c, "x") for i, v, c in rows], "vec_id long, embedding array<double>, label int, id string")
    found = vector_dedup.vector_dedup(df, **sizes)
    assert rows_of(found, "id", "n_links", "component_id", "kept") == brute_vectors(rows)


def test_vectors_that_repeat_ids_across_and_within_labels(spark):
    rng = np.random.default_rng(4)
    near = lambda c: [float(x) for x in np.eye(5)[c] + rng.normal(size=5) * 0.01]
    rows = [(5, near(0), 1), (6, near(0), 1), (5, near(1), 2), (7, near(1), 2), (8, near(1), 2), (9, near(2), 1), (9, near(2), 1), (9, near(3), 2), (4, near(3), 2), (9, None, 1), (11, [1.0, 0.0, 0.0, 0.0, 0.0], 3), (11, [1.0, 0.0, 0.0, 0.0, 0.0], 3)]
    want = brute_vectors(rows)
    assert want[5, 1, 5, True] == want[5, 2, 5, True] == 1 and want[11, 1, 11, True] == 2 and want[9, 1, 4, False] == 3
    for kind, mark in (("int", int), ("string", str)):
        df = spark.createDataFrame([(i, v, mark(c), "x", 1.0) for i, v, c in rows], f"vec_id long, embedding array<double>, label {kind}, rep string, no double")
        assert rows_of(vector_dedup.vector_dedup(df, cell_rows=2, block_rows=2), "id", "n_links", "component_id", "kept") == want


def test_cosines_at_the_threshold_are_summed_exactly():
    a, b = vector_dedup.unit(np.random.default_rng(0).normal(size=(2, 30, 64)).reshape(60, 64)).reshape(2, 30, 64)
    exact = float(math.fsum(a[3] * b[7]))
    numbers = np.arange(60)
    for home, other, hid, oid in ((a, b, numbers[:30], numbers[30:]), (b, a, numbers[30:], numbers[:30])):
        at = (3, 7) if home is a else (7, 3)
        for limit, linked in ((exact, True), (np.nextafter(exact, 2), False)):
            links, *_ = vector_dedup.block_links(home[[at[0]]], hid[[at[0]]], other[[at[1]]], oid[[at[1]]], np.ones(1, np.int64), limit)
            assert bool(links[0]) == linked


def test_vectors_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_dedup.vector_dedup(df).count() == 0


# --------------------------------------------------------------- 2: sharding
def test_shards(spark, odd):
    got = sharding.shard_rows(odd, shards=8, seed=20).collect()
    assert len(got) == len(ODD) + 4
    sizes = Counter(r["shard"] for r in got)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert sorted(r["row_no"] for r in got) == list(range(len(got)))
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in [*enumerate(ODD), (4, "a"), (5, "another text"), (None, "no id"), (None, None)])
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in got) == want


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101])
def test_the_permutation_is_one(spark, n):
    got = spark.range(n).select(sharding.permuted(F.col("id"), n, 5).alias("p")).collect()
    assert sorted(r["p"] for r in got) == list(range(n))


def test_shards_on_disk(spark, odd, tmp_path):
    sharding.write_shards(odd, str(tmp_path / "out"), shards=3)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == odd.count() and back.groupBy("shard").agg(F.max("slot") + 1 - F.count("*")).agg(F.max(F.abs(F.col("((max(slot) + 1) - count(1))")))).first()[0] == 0


def test_shards_of_an_empty_table(empty):
    assert sharding.shard_rows(empty).count() == 0


# --------------------------------------------------------------- 3: language model
def brute_scores(rows, target, mix=0.25, strength=5.0):
    """Losses by exact words and bigrams in memory; ``target`` are the ids of the target."""
    texts = [WORD.findall(t or "") for _, t in rows]
    chosen = [i is not None and i in target for i, _ in rows]
    size = [len((t or "").encode()) for _, t in rows]
    part = sum(n for n, c in zip(size, chosen, strict=True) if c)
    scale = part / sum(size) if part else 1.0
    steps = [list(zip(["<s>", *x], x)) for x in texts]  # noqa: B905
    counts = lambda pick: Counter(k for x, c in zip(steps, chosen, strict=True) if pick(c) for u, w in x for k in (u, (u, w)))
    every, of_target = counts(lambda c: True), counts(bool)
    b = {k: n * scale for k, n in every.items()}
    u = {k: (1 - mix) * of_target[k] + mix * n for k, n in b.items()}
    loss = lambda c, v, w: math.log(c[v] + strength) - math.log(c[v, w])
    return [(i, len(x), *((sum(loss(c, *s) for s in x) / len(x)) if x else None for c in (u, b))) for (i, _), x in zip(rows, steps, strict=True)]


def odd_rows():
    return [*enumerate(ODD), (4, "a"), (5, "another text"), (None, "no id"), (None, None)]


@pytest.mark.parametrize("sizes", [{}, {"MARKED": 3, "PIECE": 64, "HELD": 100, "BUCKET_BYTES": 1 << 14, "DOCS": 8}])
def test_scores_match_brute_force(spark, odd, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(lm_score, name, value)
    target = {4, 9, 10, 14, 77}
    found = lm_score.cross_entropy_difference(odd, spark.createDataFrame([(t,) for t in [*target, None]], "doc_id long")).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1], x[2] or 0)
    got = sorted(((r["id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in found), key=order)
    for g, w in zip(got, sorted(brute_scores(odd_rows(), target), key=order), strict=True):
        assert g[:2] == w[:2] and (g[2] is None) == (w[2] is None)
        if g[2] is not None:
            assert g[2:] == pytest.approx(w[2:], rel=1e-9)
    assert all(r["kept"] == (r["score"] is not None and r["score"] > 0) for r in found)


def test_scores_of_files_match_brute_force(spark, small, labels):
    docs = load(spark, small, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    good = {r["id"] for r in lm_score.labelled_target(load(spark, small, "labels")).collect()}
    assert good and good < {i for i, _ in rows}
    got = {r["id"]: (r["target_loss"], r["background_loss"]) for r in lm_score.cross_entropy_difference(docs, lm_score.labelled_target(load(spark, small, "labels"))).collect()}
    for i, n, *want in brute_scores(rows, good):
        assert got[i] == ((None, None) if not n else pytest.approx(tuple(want), rel=1e-9))


def test_scores_without_target_or_rows(spark, odd, empty):
    nothing = spark.createDataFrame([], "doc_id long")
    assert lm_score.cross_entropy_difference(odd, nothing).count() == odd.count()
    assert lm_score.cross_entropy_difference(empty, nothing).count() == 0


def test_labels_that_disagree_mark_no_target(spark, labels):
    assert {r["id"] for r in lm_score.labelled_target(labels).collect()} == {9, 14}


def test_equal_words_have_equal_keys_wherever_they_stand(monkeypatch):
    texts = [b"a bb ccc dddd eeeee ffffff ggggggg hhhhhhhhhhhh i", b"", None, b"       ", b"x" * 40, b"a\tb\nc  d ", b"bb a", b"\x0ba"]
    monkeypatch.setattr(lm_score, "PIECE", 7)
    keys, n = lm_score.word_keys(texts)
    words = [w for t in texts for w in (t or b"").split()]
    assert n.tolist() == [len((t or b"").split()) for t in texts] and len(keys) == len(words)
    assert len({*zip(words, keys.tolist(), strict=True)}) == len(set(words)) == len(set(keys.tolist()))


# ------------------------------------------------------------ 4: SentencePiece
def test_pieces_match_the_library(odd):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    back = pieces.decode_documents(pieces.encode_documents(odd, path), path).collect()
    texts = {zlib.crc32((t or "").encode()): t or "" for t in [*ODD, "another text", "no id"]}
    assert len(back) == len(ODD) + 4
    for r in back:
        text = texts[r["text_crc32"]]
        assert r["ids"] == sp.encode(text), text[:60]
        assert r["decoded"] == (text.replace("▁", " "))


def test_pieces_of_driver_texts(spark, small):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = load(spark, small, "documents")
    want = {r["doc_id"]: sp.encode(r["text"]) for r in docs.collect()}
    assert {r["id"]: r["ids"] for r in pieces.encode_documents(docs, path).collect()} == want


def test_long_runs_cost_little_more_than_their_length():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), pieces.load_pieces(path)
    draw = random.Random(2)
    texts = [" " * n for n in (1, 2, 3, 15, 16, 17, 31, 33, 100)] + ["".join(draw.choice("   ab\n") for _ in range(80)) for _ in range(300)] + ["ab" + " " * n + "c" for n in range(40)]
    assert [np.frombuffer(b, "<i4").tolist() for b in model.encode(texts)] == [sp.encode(t) for t in texts]
    for text in (" " * 1_000_000, "x" * 300_000, "a " * 500_000, "\n" * 1_000_000):
        began = time.process_time()
        model.encode([text])
        assert time.process_time() - began < 20


def test_a_unigram_vocabulary_takes_the_best_score():
    known = {"▁": (1, -3.0), "a": (2, -2.0), "b": (3, -2.0), "ab": (4, -3.0), "▁a": (5, -2.5), "bab": (6, -9.0)}
    model = pieces.Pieces(known, [], 0, "unigram", True)
    got = [np.frombuffer(x, "<i4").tolist() for x in model.encode(["ab", "abab", "b?a", ""])]

    def best(word):
        if not word:
            return 0.0, []
        options = []
        for n in range(1, len(word) + 1):
            t = word[:n]
            if t in known or n == 1:
                s, ids = best(word[n:])
                options.append((s + (known[t][1] if t in known else model.floor), [known[t][0] if t in known else 0, *ids]))
        return max(options, key=lambda o: o[0])

    assert got == [best("▁ab")[1], best("▁abab")[1], best("▁b?a")[1], []]


# ------------------------------------------------------------ 5: quality rules
def brute_statistics(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))  # noqa: B905
    covered = {j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in (k, k + 1, k + 2)}  # noqa: B905
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    n = len(words)
    return n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_statistics_match_brute_force(spark, odd, small):
    columns = ("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    rows = [*enumerate(ODD), (4, "a"), (5, "another text"), (None, "no id"), (None, None)]
    assert rows_of(quality_rules.statistics(odd), *columns) == Counter((i, *brute_statistics(t)) for i, t in rows)
    docs = load(spark, small, "documents")
    assert rows_of(quality_rules.statistics(docs), *columns) == Counter((r["doc_id"], *brute_statistics(r["text"])) for r in docs.collect())


def test_rules_learn_the_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = load(spark, sf, "documents"), load(spark, sf, "labels")
    judged, rules = quality_rules.judge(docs, labels)
    assert rules.rules and all(len(r) <= 3 for r in rules.rules)
    held = judged.join(labels, F.col("id") == labels["doc_id"]).where(F.crc32(F.col("id").cast("string")) % 5 == 0).collect()
    good, bad = [r["kept"] for r in held if r["quality"] == 1], [r["kept"] for r in held if r["quality"] == 0]
    passing_base = [r["kept"] for r in held if r["quality"] == 1 and not r["base_failed"]]
    assert sum(passing_base) / len(passing_base) > 0.95 and sum(bad) / len(bad) < 0.4 and len(good) > 20


def test_rules_without_labels_or_rows(spark, odd, empty, labels):
    none = labels.where("false")
    judged, rules = quality_rules.judge(odd, none)
    assert not rules.rules and all(r["kept"] == (not r["base_failed"]) for r in judged.collect())
    assert quality_rules.judge(odd, labels)[0].count() == odd.count()
    assert quality_rules.judge(empty, labels)[0].count() == 0


# -------------------------------------------------------------- 6: token files
def test_token_files_match_the_library(spark, odd, small, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    for name, df in (("odd", odd), ("docs", load(spark, small, "documents"))):
        out = str(tmp_path / name)
        token_files.write_token_files(df, out, path, docs_per_record=7)
        got = sorted(((r["id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_documents(spark, out).collect()), key=lambda r: r[1])
        want = [(r["doc_id"], ids) for r in df.collect() for ids in [[*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]]]
        assert Counter((i, n, c) for i, _, n, c in got) == Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
        assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda i: (i is not None, i or 0))
        at = 0
        for _, start, n, _ in got:
            assert start == at
            at += n


def test_token_lookup(spark, odd, tmp_path):
    from tokenizers import Tokenizer

    path, out = public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "x")
    token_files.write_token_files(odd, out, path, docs_per_record=4)
    got = {r["id"]: r["ids"] for r in token_files.lookup(spark, out, [6, 9, 999, -5]).collect()}
    encode = lambda t: [*Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids, 0]
    assert got == {6: encode(ODD[6]), 9: encode(ODD[9])}


def test_every_key_leads_to_its_document(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "CELL", 16)
    docs, out = load(spark, small, "documents"), str(tmp_path / "all")
    token_files.write_token_files(docs.unionByName(docs), out, public_tokenizers.path("byte_bpe_50k.json"), docs_per_record=9)
    base = {(r["part"], r["seq"]): r["base"] + r["part_start"] for r in token_files._with_base(spark.read.parquet(f"{out}/payload")).collect()}
    first = {}
    for r in token_files.read_documents(spark, out).collect():
        first[r["id"]] = min(first.get(r["id"], (1 << 60, 0)), (r["start"], r["n_tokens"]))
    found = token_files.locate(spark, out, [*first, -7, 10**12])
    assert {k: (base[part, seq] + start, n) for k, part, seq, start, n in found if k in first} == first
    assert sum(r["n_keys"] for r in spark.read.parquet(f"{out}/index").collect()) == len(first)


def test_words_are_cut_as_the_library_cuts_them():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, mine = Tokenizer.from_file(path), token_files.Encoder(path, 10)
    draw = random.Random(8)
    texts = ["".join(draw.choice("ab'sStT re.,\n\n 12é ßÆ|<>\t\xa0漢  ") for _ in range(draw.randrange(60))) for _ in range(3000)]
    for i in range(0, len(texts), 50):
        got = mine.encode(texts[i : i + 50])
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [library.encode(t, add_special_tokens=False).ids for t in texts[i : i + 50]]


def test_a_word_is_looked_up_once_however_often_it_stands():
    from tokenizers import Tokenizer

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    path = public_tokenizers.path("byte_bpe_50k.json")
    mine, library = token_files.Encoder(path, 1000), Tokenizer.from_file(path)
    mine.after = Counted()
    texts = ["the river and the sea. " * 500 + "end" for _ in range(20)]
    assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counted.asked < 100


def test_words_that_end_in_marks_match_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library, mine = Tokenizer.from_file(path), token_files.Encoder(path, 40)
    draw = random.Random(5)
    words = ["".join(draw.choice("abstéßÆªñ") for _ in range(draw.randrange(6))) + "".join(draw.choice("'.,*«»¿$|s2\n²") for _ in range(draw.randrange(4))) for _ in range(2000)]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randrange(30))) for _ in range(600)] + ["", "漢字", "one", "<|endoftext|>"]
    for group in (texts, texts[:300], ["", ""], ["<|endoftext|>"], []):
        assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode(group)] == [library.encode(t, add_special_tokens=False).ids for t in group]


def test_the_library_gets_few_texts_at_a_time(monkeypatch):
    monkeypatch.setattr(token_files, "LIBRARY_CHARS", 300)
    mine = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 1000)
    texts = ["  two  spaces ", "", "漢字 и слова", "x" * 900] * 5
    library, sizes = mine.tokenizer, []

    class Watched:
        def encode_batch(self, group, **options):
            sizes.append(sum(len(t) + 64 for t in group[:-1]))
            return library.encode_batch(group, **options)

    mine.tokenizer = Watched()
    assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(sizes) > 2 and max(sizes) < 300


def test_the_cache_stays_near_its_limit_in_a_slice_of_different_words(monkeypatch):
    monkeypatch.setattr(token_files, "LOOKED_UP", 50)
    mine = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 100)
    texts = [" ".join("".join("abcdefghij"[int(c)] for c in str(n)) for n in range(k * 100, k * 100 + 100)) for k in range(1, 21)]
    assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode(texts)] == [mine.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(mine.after) <= 150


def test_slices_hold_all_rows_in_order(monkeypatch):
    monkeypatch.setattr(token_files, "SLICE_BYTES", 10)
    texts = ["é" * 3, None, "a" * 4, "b", "c" * 50, "", "d" * 10, "e", "f" * 9]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, pa.string())], names=["id", "text"])
    slices = [s.column(1).to_pylist() for s in token_files._slices(batch)]
    assert slices == [["ééé", None, "aaaa"], ["b"], ["c" * 50], ["", "d" * 10], ["e", "f" * 9]]
    assert list(token_files._slices(batch.slice(0, 0))) == []


def test_the_index_is_minimal_and_perfect():
    for n in (0, 1, 2, 50, 3000):
        keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
        seeds, prints, positions = token_files.build_index(keys)
        assert sorted(positions.tolist()) == list(range(len(keys)))
        assert (token_files.find(keys, seeds, prints, positions) == np.arange(len(keys))).all()
        others = keys + 1 if n else np.array([5])
        assert (token_files.find(others, seeds, prints, positions) >= 0).mean() < 0.05


def test_token_files_of_an_empty_table(spark, empty, tmp_path):
    token_files.write_token_files(empty, str(tmp_path / "e"), public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read_documents(spark, str(tmp_path / "e")).count() == 0


# ------------------------------------------------------------------- 7: mixing
def test_raking_meets_all_marginals():
    cells = {(a, b, c): float(1 + 3 * a + 5 * b * c) for a in range(3) for b in range(2) for c in range(2)}
    goals = [{0: 0.5, 1: 0.3, 2: 0.2}, {0: 0.6, 1: 0.4}, {0: 0.7, 1: 0.3}]
    raked = mixing.rake(cells, goals)
    total = sum(raked.values())
    assert total == pytest.approx(sum(cells.values()))
    for axis, goal in enumerate(goals):
        for g, share in goal.items():
            assert sum(v for c, v in raked.items() if c[axis] == g) / total == pytest.approx(share, abs=1e-6)


def test_chances_meet_the_share():
    tokens, weights = {(k,): 10.0 * (k + 1) for k in range(5)}, {(k,): [0.0, 0.2, 1.0, 3.0, 9.0][k] for k in range(5)}
    chance = mixing.calibrate(tokens, weights, 0.5)
    assert sum(tokens[c] * chance[c] for c in tokens) == pytest.approx(75.0) and chance[(0,)] == 0 and max(chance.values()) <= 1


def test_mixing_on_driver_rows(spark):
    docs = load(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix(docs, temper=0.7, share=0.6, seed=7).collect()
    words = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    assert all(r["n_tokens"] == words[r["row"]["doc_id"]] for r in rows)
    total = sum(r["n_tokens"] for r in rows)
    assert sum(r["n_tokens"] * r["probability"] for r in rows) / total == pytest.approx(0.6, abs=1e-6)
    assert abs(sum(r["n_tokens"] for r in rows if r["kept"]) / total - 0.6) < 0.08
    by = lambda weigh: {s: sum(weigh(r) for r in rows if r["source"] == s) for s in {r["source"] for r in rows}}
    before, after = by(lambda r: r["n_tokens"]), by(lambda r: r["n_tokens"] * r["weight"])
    goal = mixing.tempered(before, 0.7)
    assert all(after[s] / sum(after.values()) == pytest.approx(goal[s], abs=1e-6) for s in goal)
    for r in rows:
        draw = int(hashlib.md5(f"7:{r['row']['doc_id']}".encode()).hexdigest()[:13], 16) / (1 << 52)
        assert r["kept"] == (draw < r["probability"])


def test_mixing_of_odd_rows(odd, empty):
    rows = mixing.mix(odd, share=1.0, temper=1.0).collect()
    assert len(rows) == len(ODD) + 4 and all(r["kept"] for r in rows if r["n_tokens"])
    assert {r["source"] for r in rows} == {None, "s0", "s1"}
    assert mixing.mix(empty).count() == 0
    grouped = mixing.mix(odd, max_values=1, share=1.0, temper=1.0)
    assert grouped.count() == len(ODD) + 4
    only = mixing.mix(odd, targets={"source": {"s0": 1.0}}, share=0.5).collect()
    assert not any(r["kept"] for r in only if r["source"] != "s0" and r["n_tokens"])


# ------------------------------------------------------------------ 8: SimHash
def brute_print(text):
    words = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(prints)):
        for y in range(x):
            if (prints[x][1] ^ prints[y][1]).bit_count() <= 2:
                parent[root(x)] = root(y)
    low = {}
    for k, (i, _) in enumerate(prints):
        low[root(k)] = min(low.get(root(k), i), i)
    return {(i, p, low[root(k)]) for k, (i, p) in enumerate(prints)}


@pytest.mark.parametrize("bound", [64, 1])
def test_simhash_matches_brute_force(spark, small, bound):
    base = load(spark, small, "documents").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in base] + [(1000 + k, t) for k, t in enumerate(ODD)]
    found = simhash.simhash_dedup(table(spark, rows), pair_bound=bound)
    got = {(r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found.collect()}
    assert got == brute_components([(i, brute_print(t)) for i, t in rows])


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("bound", [64, 0])
def test_links_of_near_fingerprints(spark, bits, bound):
    rng = random.Random(bits)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    prints = sorted({s ^ sum(1 << b for b in rng.sample(range(64), k)) for s in seeds for k in (0, 0, 1, 1, 2, 2, 3, 4)})
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    classes = spark.createDataFrame([(signed(p), k) for k, p in enumerate(prints)], "fp long, rep long")
    from grainmill.llm.graph import connected_components

    got = {r["node"]: r["component"] for r in connected_components(simhash.links(classes, bound, bits)).collect()}
    low = {k: k for k in range(len(prints))}
    changed = True
    while changed:
        changed = False
        for x in range(len(prints)):
            for y in range(len(prints)):
                if (prints[x] ^ prints[y]).bit_count() <= bits and low[y] < low[x]:
                    low[x], changed = low[y], True
    assert {k: got.get(k, k) for k in low} == low


def test_simhash_of_odd_rows(odd, empty):
    rows = simhash.simhash_dedup(odd).collect()
    assert len(rows) == len(ODD) + 4
    assert all(r["component_id"] is None and not r["kept"] for r in rows if r["id"] is None)
    assert {r["component_id"] for r in rows if r["fp"] == 0 and r["id"] is not None} == {0}
    assert simhash.simhash_dedup(empty).count() == 0


# --------------------------------------------------------------------- 9: PII
def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def brute_spans(text):
    found = [(m.start(), k, m.end()) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind][0], text or "") if BASE[kind][1](m[0])]
    return sorted(found)


def noisy_texts(n=1500, seed=3):
    rng = random.Random(seed)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (415) 555-0100", "+49 30 1234567", "a.b@c-d.org", "x@y", "x@y.z_q@w.e", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "007.1.2.3", "+", "@", ".", "-", " ", "é", "5", "12", "378282246310005", "(415) 555-0100", "me [at] home [dot] com", "\n", "00000000000000", "v1.2.3.4"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 9))) for _ in range(n)] + ["".join(rng.choice("0123456789 .-+()@ab%_") for _ in range(rng.randrange(1, 60))) for _ in range(n)]


def test_base_spans_match_brute_force(spark):
    texts = [*noisy_texts(), *ODD, "1" * 20_000, "a" * 20_000 + "@", "+1" + " 2" * 9000, "1.2." * 5000, "@".join(["ab.c"] * 3000)]
    found = pii.detect(table(spark, list(enumerate(texts)))).collect()
    for r in found:
        base = [(s["start"], s["kind"], s["end"]) for s in r["base"]]
        assert base == brute_spans(texts[r["id"]]), texts[r["id"]][:80]
        spans = [(s["start"], s["kind"], s["end"]) for s in r["spans"]]
        assert set(base) <= set(spans) and spans == sorted(spans)
        for s in set(spans) - set(base):
            assert not any(s[0] < b[2] and b[0] < s[2] for b in base)


def test_redaction_masks_spans_and_keeps_columns(spark, odd, empty):
    texts = ["write to a@b.co or 10.0.0.1.", None, "nothing here", "+1 (415) 555-0100 calls 4111 1111 1111 1111"]
    out = pii.redact(table(spark, list(enumerate(texts))))
    assert out.schema == odd.schema
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert got[0] == ("write to <EMAIL> or <IP>.", 25) and got[1] == (None, None) and got[2] == ("nothing here", 12)
    assert got[3][0] == "<PHONE> calls <CARD>"
    assert pii.redact(empty).count() == 0 and pii.detect(empty).count() == 0 and pii.redact(odd).count() == odd.count()


def test_candidates_are_accepted_and_refused(spark):
    draw = random.Random(11)
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    secrets = [f'filler token = "{hexes(40)}" more' for _ in range(60)] + [f"API_KEY: {hexes(32)}" for _ in range(20)]
    names = [f"see part_{draw.randrange(9)}_of_the_{draw.choice(['long', 'short'])}_section_list" for _ in range(60)] + [f"row aaaaaaaaaa{k}bbbbbbbbbbbbb0 here" for k in range(20)]
    mails = [f"mail me (at) home{k}.com" for k in range(20)] + [f"write to a.b{k}@home{k}.com now" for k in range(60)]
    texts = [*secrets, *names, *mails]
    found = {r["id"]: [(s["kind"], texts[r["id"]][s["start"] : s["end"]]) for s in r["spans"]] for r in pii.detect(table(spark, list(enumerate(texts)))).collect()}
    assert sum(any(k == 4 for k, _ in found[i]) for i in range(80)) >= 78
    assert all(len(x.strip('"')) in (32, 40) for i in range(80) for k, x in found[i] if k == 4)
    assert not any(found[i] for i in range(80, 160))
    assert all(any(k == 0 for k, _ in found[i]) for i in range(180, 240))


def test_many_spans_cost_little_more_than_their_length(spark, tmp_path):
    many = {"mails": "a.b@c.de " * 4_000, "numbers": "10.0.0.1, +1 (415) 555-0100, " * 2_000, "tokens": "token = 0123456789abcdef0123456789 a@b.co " * 2_000}
    for k, (name, text) in enumerate(many.items()):
        table(spark, [(k, text)]).write.parquet(str(tmp_path / name))  # a local row would be evaluated while it is planned
        df = spark.read.parquet(str(tmp_path / name))
        began = time.monotonic()
        n = {"mails": 4_000, "numbers": 4_000, "tokens": 4_000}[name]
        row = pii.detect(df).collect()[0]
        assert len(row["base"]) == (2_000 if name == "tokens" else n) and len(row["spans"]) >= len(row["base"])
        out = pii.redact(df).collect()[0]["text"]
        assert "@" not in out and "10.0.0.1" not in out and out.count("<") == len(row["spans"])
        assert time.monotonic() - began < 120, name


def test_reliabilities_tell_good_from_bad_labelers():
    rng = random.Random(2)
    counted = Counter()
    for _ in range(4000):
        truth = rng.random() < 0.6
        votes = tuple((1 if (rng.random() < acc) == truth else -1) if rng.random() < 0.9 else 0 for acc in (0.95, 0.9, 0.85, 0.8, 0.55))
        counted[0, votes] += 1
    _, rel = pii.reliabilities([(k, v, n) for (k, v), n in counted.items()])
    sens = [rel[v][0] for v in pii.VOTERS]
    assert sens[0] > 0.9 and sens[4] < 0.65


# -------------------------------------------------------------- 10: classifier
def test_quality_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.01"
    found = pu_quality.classify(load(spark, sf, "documents"), load(spark, sf, "labels"))
    truth = {r["doc_id"]: r["quality"] for r in load(spark, sf, "labels").collect()}
    held = [(r["score"], truth[r["id"]]) for r in found.collect() if r["held_out"] and r["id"] in truth]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    area = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert area > 0.9 and sum(s >= 0.3 for s in good) / len(good) > 0.95


def test_scores_of_odd_rows(odd, empty, labels):
    rows = pu_quality.classify(odd, labels).collect()
    assert len(rows) == len(ODD) + 4
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (r["id"] is not None and zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)
    assert pu_quality.classify(empty, labels).count() == 0
    assert pu_quality.classify(odd, labels.where("false")).count() == len(ODD) + 4
    kept = pu_quality.keep_predicted(odd, labels)
    assert kept.schema.fieldNames() == odd.schema.fieldNames()


def risk_rows(n=500, prior=0.7, seed=0):
    rng = np.random.default_rng(seed)
    width = len(pu_quality.FEATURES)
    pos, neg = rng.normal(1, 1, (n, width)), rng.normal(-1, 1, (n, width))
    unl = np.concatenate([rng.normal(1, 1, (int(n * prior), width)), neg[: n - int(n * prior)]])
    edges = [np.quantile(unl[:, j], (0.1, 0.3, 0.5, 0.7, 0.9)) for j in range(width)]
    return pos, neg, unl, edges


def test_the_risk_separates_classes_and_its_gradient_is_one():
    pos, neg, unl, edges = risk_rows()
    width = sum(len(e) + 1 for e in edges)
    at, au = pu_quality.indexed(pos, edges), pu_quality.indexed(unl, edges)
    whole = lambda w: pu_quality.risk(w, at, pu_quality.unlabelled_part(au, w, width), 0.7, 1e-4)
    start = np.append(np.zeros(width), np.log(0.7 / 0.3))
    done = pu_quality.adam(start, lambda w: whole(w)[1], 1500, 0.1)
    assert whole(done)[0] < whole(start)[0]
    model = pu_quality.Model(edges, np.split(done[:-1], np.cumsum([len(e) + 1 for e in edges])[:-1]), float(done[-1]), 0.7)
    assert model.score(pos).mean() > 0.8 and model.score(neg).mean() < 0.3
    w = np.random.default_rng(1).normal(0, 0.05, width + 1)
    value, grad = whole(w)
    for k in (0, 7, width - 1, width):
        step = np.zeros(width + 1)
        step[k] = 1e-6
        assert (whole(w + step)[0] - value) / 1e-6 == pytest.approx(grad[k], rel=1e-3, abs=1e-6)


def test_training_sums_over_all_unlabelled_rows(spark):
    """From the same start, passes over the table take the steps that all rows in memory give."""
    pos, neg, unl, _ = risk_rows(400)
    rows = [(i, x.tolist()) for i, x in enumerate(np.concatenate([pos, unl]).astype(np.float32))]
    table = spark.createDataFrame(rows, "id long, features array<float>")
    labels = spark.createDataFrame([(i, 1) for i in range(len(pos))], "doc_id long, quality int")
    out = [i for i in range(len(rows)) if zlib.crc32(str(i).encode()) % 5]
    p, u = ([rows[i][1] for i in out if (i < len(pos)) == side] for side in (True, False))
    given = {"prior": 0.7, "sample_bound": 1000, "rounds": 0, "decay": 1e-3, "last_rate": 0.1}
    model = pu_quality.train(table, labels, passes=7, **given)
    width = sum(len(e) + 1 for e in model.edges)
    au, at = (pu_quality.indexed(np.array(x, dtype=np.float64), model.edges) for x in (u, p))
    want = pu_quality.adam(np.append(np.zeros(width), np.log(0.7 / 0.3)), lambda w: pu_quality.risk(w, at, pu_quality.unlabelled_part(au, w, width), 0.7, 1e-3)[1], 7, 0.1)
    assert np.allclose(np.append(np.concatenate(model.weights), model.bias), want)
    small = given | {"sample_bound": 50, "rounds": 30, "passes": 2}
    once, again = (pu_quality.train(t, labels, **small) for t in (table.orderBy("id"), table.repartition(3)))
    assert np.allclose(np.concatenate(again.weights), np.concatenate(once.weights))


# ------------------------------------------------------------------ the graph
def test_components_of_chains_hubs_and_nothing(spark):
    from grainmill.llm.graph import connected_components

    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 5 for k in range(5, 40)} | {200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
