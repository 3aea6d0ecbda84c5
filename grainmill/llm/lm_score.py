"""Language-model scoring by cross-entropy difference.

Two bigram models, of target documents and of the background (all documents), share one
vocabulary: all words of the background. Background counts b are scaled to the size of the
target (by bytes), and the target's counts t are mixed with them, so both models are smoothed
alike and the same relative counts give the same loss (matched models):

    background  p(w|v) = b(v, w) / (b(v) + m)
    target      p(w|v) = u(v, w) / (u(v) + m),   u = (1 - mix) t + mix b

v counts where a word follows it, and the start of a text is a context, too; m is the weight
of all words not seen after v. Every bigram of a document is in the background, so none is
left to that weight. A document's score is the mean over its tokens of background loss minus
target loss, in nats: above zero it is more like the target than like the background.

Tokens are words between ASCII white space. Every context and every bigram of every document
is in the models, also those that occur once, so the models grow with the corpus, and no
task and not the driver ever holds them as a whole. A loss is a term of the context and a
term of the bigram, so it is summed where the counts are:

1. One pass over the texts hashes contexts and bigrams to 64-bit keys. A task collects some
   millions of them in a *unit*: distinct keys, and for each the documents it occurs in.
2. Units, cut into ranges of keys (*buckets*), meet in one shuffle. A bucket adds up the
   counts of its keys and then the terms of each document. A frequent key is one entry of a
   unit, so it is no hot key.
3. The sums of a document are added over the buckets of a task, and over tasks by unit.

The target is marked by file and row (`marked`), and texts are never shuffled where Spark
finds the marks (four bytes for each target row) small enough to broadcast.

Keys are compared by hash: among n contexts or bigrams about n * n / 2 ** 64 pairs share a
key (2 ** 63 keys for each kind), and then share their counts.

Defined cases: null, empty and blank texts have no tokens, null losses and a null score, and
are not kept; repeated rows and ids count and are scored as rows of their own, and a target
id marks all of its rows; null ids are background; without any target text the target model
is the background's, mixed down; an empty table gives an empty result; very long texts are
hashed in pieces cut between words, and a text's keys are held at once; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, worker_cache

#: Rows that are marked together, text hashed at a time, tokens of a unit, and text for each bucket.
MARKED, PIECE, HELD, BUCKET_BYTES = 1 << 13, 1 << 20, 2_500_000, 1 << 23
#: Documents of a unit; the bit above their numbers marks the target.
DOCS = 1 << 15
#: The context before the first word. Contexts have even keys, bigrams odd ones.
START = np.uint64(0x5374617274206F66 & ~1)
_EVEN, _ONE = np.uint64(~np.uint64(1)), np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = np.random.default_rng(3).integers(0, 1 << 64, 256, dtype=np.uint64)
_UNITS = "bucket long, unit long, keys binary, n binary, docs binary, ids array<long>"
_UNIT_NAMES = [x.split()[0] for x in _UNITS.split(", ")]
_SUMS = "unit long, docs binary, n binary, target binary, background binary, ids array<long>"
#: Sums of documents that a task holds before it hands them on.
HELD_SUMS = 2_000_000
_SUM_NAMES = [x.split()[0] for x in _SUMS.split(", ")]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending powers of the base and of its inverse, modulo 2 ** 64."""
    cache = worker_cache("powers")
    if n in cache:
        return cache[n]
    cache.clear()
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    cache[n] = np.cumprod(up), np.cumprod(down)
    return cache[n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _hash(buffer: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word keys, words of each text) of texts that lie in ``buffer``, each with a space after it.

    A word's hash is its value as a polynomial, read off the running sums of the buffer.
    """
    raw = np.frombuffer(buffer, np.uint8)
    up, down = _powers(max(PIECE + 1, len(raw)))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[: len(raw)], out=sums[1:])
    edges = np.flatnonzero(np.diff(_SPACES[raw], prepend=True))
    starts, ends = edges[::2], edges[1::2]
    ends_of = np.cumsum(sizes)
    words = np.diff(np.searchsorted(starts, ends_of), prepend=0)
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)) & _EVEN, words


def _pieces(text: bytes) -> Iterator[bytes]:
    """A long text in pieces cut at white space; a word longer than a piece stays whole."""
    at = 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not _SPACES[text[end]]:
            end += 1
        yield text[at:end]
        at = end


def word_keys(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all words in order, words of each text)."""
    keys: list[np.ndarray] = []
    words = np.zeros(len(texts), np.int64)
    held: list[int] = []
    size = 0

    def flush() -> None:
        if held:
            some = [texts[i] or b"" for i in held]
            got, n = _hash(b" ".join([*some, b""]), np.array([len(t) + 1 for t in some]))
            keys.append(got)
            words[held] = n
            held.clear()

    for i, text in enumerate(texts):
        n = len(text or b"")
        if held and size + n > PIECE:
            flush()
            size = 0
        if n > PIECE:
            for piece in _pieces(text):
                got, k = _hash(piece + b" ", np.array([len(piece) + 1]))
                keys.append(got)
                words[i] += int(k[0])
        else:
            held.append(i)
            size += n + 1
    flush()
    return np.concatenate([np.zeros(0, np.uint64), *keys]), words


def context_keys(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The key of the word before each word in its text."""
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[(np.cumsum(words) - words)[words > 0]] = START
    return before


def bigram_keys(keys: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return _mix(contexts * np.uint64(0xD6E8FEB86659FD93) + keys) | _ONE


def _slices(batch: pa.RecordBatch, column: int, most: int = 4 * PIECE) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of bounded bytes of text, single rows at least."""
    texts = batch.column(column)
    sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]) if len(texts) else np.zeros(0, np.int32)
    at, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > at and held + n > most:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < batch.num_rows:
        yield batch.slice(at)


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, block, slot): rows with a place that any scan of the same files gives them."""
    text = F.col(f"`{text_col}`").cast("string").cast("binary")
    wanted = [F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")]
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    try:
        rows = docs.select(*wanted, *place)
        rows.schema  # noqa: B018
    except AnalysisException:  # not read from files with row numbers
        rows = materialize(docs.select(*wanted), "lm-docs").select("id", "text", *place)
    slot = F.col("_row") % MARKED
    return rows.select("id", "text", F.xxhash64("_file", F.col("_row") - slot).alias("block"), slot.cast("int").alias("slot"))


def marked(rows: DataFrame, target_ids: DataFrame) -> tuple[DataFrame, float, int]:
    """((id, target, text), bytes of the target in those of all, bytes of all).

    Ids meet without texts. What goes back to the texts is four bytes for each target row,
    broadcast if Spark finds it small enough by its size and joined by block otherwise.
    """
    ids = target_ids.select(F.col(target_ids.columns[0]).cast("long").alias("_good")).distinct()
    sized = rows.select("id", "block", "slot", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    found = materialize(sized.join(ids, F.col("id") == F.col("_good"), "left_semi").groupBy(F.col("block").alias("_block")).agg(F.collect_list("slot").alias("_slots"), F.sum("size").alias("size")), "lm-target")
    part, whole = (df.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] for df in (found, sized))
    both = rows.join(found.select("_block", "_slots"), rows["block"] == F.col("_block"), "left")
    return both.select("id", F.coalesce(F.array_contains("_slots", F.col("slot")), F.lit(False)).alias("target"), "text"), part / whole if part else 1.0, whole


def units(rows: DataFrame, buckets: int) -> DataFrame:
    """Keys of a unit by bucket, how often each occurs and in which documents; and the ids of the unit's documents.

    Ids come in buckets of their own, with numbers below zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        keys: list[np.ndarray] = []
        docs: list[np.ndarray] = []
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal made, size
            unit = (part << 32) + made
            # What is no longer needed is let go at once: these are the largest arrays of the task.
            every, where = np.concatenate([np.zeros(0, np.uint64), *keys]), np.concatenate([np.zeros(0, np.uint16), *docs])
            keys.clear()
            docs.clear()
            order = np.argsort(every, kind="stable")
            every, where = every[order], where[order]
            del order
            at = np.flatnonzero(np.diff(every, prepend=~every[:1]))
            bounds, distinct, n = np.append(at, len(every)), every[at], np.diff(at, append=len(every)).astype(np.uint32)
            del every, at
            bucket = ((distinct >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            cuts = np.flatnonzero(np.diff(bucket, prepend=buckets, append=buckets)).tolist() if len(distinct) else [0]
            named = bucket[cuts[:-1]].tolist()
            for k in range(0, len(named), 16):
                some = list(zip(cuts[k : k + 16], cuts[k + 1 : k + 17]))  # noqa: B905
                blobs = [[distinct[i:j].tobytes() for i, j in some], [n[i:j].tobytes() for i, j in some], [where[bounds[i] : bounds[j]].tobytes() for i, j in some]]
                yield pa.record_batch([pa.array(named[k : k + 16], pa.int64()), pa.array([unit] * len(some), pa.int64()), *(pa.array(x, pa.binary()) for x in blobs), pa.array([None] * len(some), pa.list_(pa.int64()))], names=_UNIT_NAMES)
            yield pa.record_batch([pa.array([-1 - unit % buckets], pa.int64()), pa.array([unit], pa.int64()), *[pa.array([None], pa.binary())] * 3, pa.array([ids], pa.list_(pa.int64()))], names=_UNIT_NAMES)
            made, size = made + 1, 0
            ids.clear()

        for whole in batches:
            for batch in _slices(whole, 2):
                for start in range(0, batch.num_rows, DOCS // 4):
                    piece = batch.slice(start, DOCS // 4)
                    if len(ids) + piece.num_rows > DOCS or size > HELD:
                        yield from out()
                    found, words = word_keys(piece.column(2).to_pylist())
                    mark = np.arange(len(ids), len(ids) + piece.num_rows, dtype=np.uint16) | (piece.column(1).to_numpy(zero_copy_only=False).astype(np.uint16) * np.uint16(DOCS))
                    contexts = context_keys(found, words)
                    keys += [contexts, bigram_keys(found, contexts)]
                    docs += [np.repeat(mark, words)] * 2
                    ids += piece.column(0).to_pylist()
                    size += len(found)
        if ids:
            yield from out()

    return rows.select("id", "target", "text").mapInArrow(run, _UNITS)


def _terms(rows: list[dict], scale: float, mix: float, strength: float) -> Iterator[tuple[int, np.ndarray]]:
    """For each unit of a bucket: tokens, target and background terms by document."""
    keys, n, docs = (np.frombuffer(b"".join(r[c] for r in rows), d) for c, d in (("keys", "<u8"), ("n", "<u4"), ("docs", "<u2")))
    order = np.argsort(keys, kind="stable")
    fresh = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(fresh) - 1
    occurs = np.repeat(place, n)
    b = np.bincount(occurs).astype(np.float64) * scale
    u = mix * b + (1 - mix) * np.bincount(occurs, weights=docs >= DOCS)
    context = keys[order][fresh] & _ONE == 0
    values = [context.astype(np.float64), *(np.where(context, np.log(x + strength), -np.log(x)) for x in (u, b))]
    at = 0
    for r in rows:
        to = at + len(r["docs"]) // 2
        whose = docs[at:to] & np.uint16(DOCS - 1)
        yield r["unit"], np.stack([np.bincount(whose, weights=x[occurs[at:to]], minlength=1) for x in values])
        at = to


def sums(held: DataFrame, scale: float, mix: float, strength: float) -> DataFrame:
    """(unit, docs, n, target, background): terms by document over all buckets of a task; and the ids of units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        rows: list[dict] = []

        def close() -> None:
            for unit, some in _terms(rows, scale, mix, strength) if rows else ():
                have = totals.get(unit)
                if have is None or have.shape[1] < some.shape[1]:
                    have, old = np.zeros((3, some.shape[1])), have
                    if old is not None:
                        have[:, : old.shape[1]] = old
                    totals[unit] = have
                have[:, : some.shape[1]] += some
            rows.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for unit, x in totals.items():
                hit = np.flatnonzero(x.any(axis=0))
                blobs = (hit.astype("<u2"), *(y[hit] for y in x))
                yield pa.record_batch([pa.array([unit]), *(pa.array([y.tobytes()], pa.binary()) for y in blobs), pa.array([None], pa.list_(pa.int64()))], names=_SUM_NAMES)
            totals.clear()

        bucket = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                if row.column(0)[0].as_py() < 0:
                    yield pa.record_batch([row.column(1), *[pa.array([b""], pa.binary())] * 4, row.column(5)], names=_SUM_NAMES)
                    continue
                if row.column(0)[0].as_py() != bucket:
                    close()
                    bucket = row.column(0)[0].as_py()
                    if sum(x.shape[1] for x in totals.values()) > HELD_SUMS:
                        yield from out()
                rows.append({c: row.column(k)[0].as_py() for k, c in enumerate(_UNIT_NAMES)})
        close()
        yield from out()

    return held.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, _SUMS)


def _documents(table: pa.Table) -> pa.Table:
    """A unit's documents with their sums."""
    rows = table.to_pylist()
    ids = next(r["ids"] for r in rows if r["ids"] is not None)
    total = np.zeros((3, len(ids)))
    for r in rows:
        at = np.frombuffer(r["docs"], "<u2")
        total[:, at] += np.stack([np.frombuffer(r[c], "<f8") for c in ("n", "target", "background")])
    return pa.table([pa.array(ids, pa.int64()), pa.array(total[0].astype(np.int64)), pa.array(total[1]), pa.array(total[2])], names=["id", "n", "target", "background"])


def labelled_target(labels: DataFrame) -> DataFrame:
    """(id) of what every label marks as of good quality and not toxic."""
    good = labels.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("all"))
    return good.where("all and id is not null").select("id")


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", mix: float = 0.25, strength: float = 5.0, threshold: float = 0.0) -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score, kept) for every row of ``docs``.

    The first column of ``target_ids`` names the documents of the target; the background is
    ``docs`` as a whole.
    """
    rows, scale, size = marked(_placed(docs, id_col, text_col), target_ids)
    held = units(rows, max(1, math.ceil(size / BUCKET_BYTES)))

    found = sums(held, scale, mix, strength).groupBy("unit").applyInArrow(_documents, "id long, n long, target double, background double")
    mean = lambda c: F.when(F.col("n") > 0, F.col(c) / F.col("n"))
    out = found.select("id", F.col("n").alias("n_tokens"), mean("target").alias("target_loss"), mean("background").alias("background_loss"))
    out = out.withColumn("score", F.col("background_loss") - F.col("target_loss"))
    return out.withColumn("kept", F.coalesce(F.col("score") > threshold, F.lit(False)))
