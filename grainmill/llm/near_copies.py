"""Near copies by the Jaccard similarity of their sets of word shingles, without a miss.

Two texts are linked if their sets of five-word shingles (64-bit hashes) have a similarity of
``least`` or more. Sets of n shingles that similar share one of the first
n - ceil(least * n) + 1 shingles of each, in any order of all shingles, so these are posted,
and every list of one shingle holds every pair that it is to find. Rare shingles come first:
occurrences are counted over the whole table in 2 ** `SLOTS` slots of hashes. The counts only
decide how long lists get, never what is found.

Texts with the same words are one class and one node. First each member of a list meets one
of them, the head, which is linear in the list, and fingerprints within two bits meet (SimHash).
These links give components. Then, in lists with members of more than one component, all
members of different components meet, with no bound on a list. A pair is passed on if its
sizes and its signatures allow the similarity, and in the first list that it shares or one
soon after; signatures are the parities of 1,024 buckets of a set, which differ in no more
places than the sets do. Sets of more than `LARGE` shingles fill them, so pairs of such sets
are held against wider ones. Every pair that is left is verified on the sets.

What grows faster than a list are comparisons of signatures between components: a group of n
texts of which s are linked to none of the others costs about n * s of them in each list that
it shares. Wide signatures fill up as well, at sets far larger than 20,000 shingles.

Defined cases: letter case and white space do not count; texts of fewer than five words are
one shingle; texts without words are one class; rows with a null id are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmill.llm import simhash
from grainmill.llm.common import materialize, worker_cache
from grainmill.llm.graph import connected_components

SHINGLE, LEAST = 5, 0.8
#: Bits of a shingle's slot, and the parts in which the counts of slots are added up.
SLOTS, PARTS = 18, 64
#: Longs of a signature; shared lists that a pair looks back on.
WORDS, BACK = 16, 6
#: Bits of a slot of ids that tells whether a row's set is worked out to verify a pair.
FLAGS = 23
#: Sets larger than this fill a signature and have a second one of so many longs.
LARGE, WIDE = 1024, 256
#: Similarities are compared with this much to spare.
SPARE = 1e-9


def class_of(text: str | None) -> int:
    """A signed number that texts with the same words share."""
    words = b" ".join((text or "").encode("utf-8", "replace").lower().split())
    return int(np.uint64(xxhash.xxh3_64_intdigest(words, simhash.SEED)).view(np.int64))


def with_class(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` and the class of their texts as the column ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            classes = pa.array([class_of(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, classes], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def _chosen(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOTS)).astype(np.int64)


def slot_levels(chosen: DataFrame) -> np.ndarray:
    """A rising level of the occurrences of the shingles of each slot, four levels to a doubling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        counts = np.zeros(1 << SLOTS, np.int32)
        for batch in batches:
            for t in batch.column(0):
                np.add.at(counts, _slots(simhash.shingle_hashes(t.as_py(), SHINGLE)), 1)
        parts = [part.tobytes() for part in counts.reshape(PARTS, -1)]
        yield pa.record_batch([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(c.as_py(), np.int32).astype(np.int64) for c in table.column("counts"))
        return pa.table({"part": table.column("part").slice(0, 1), "counts": pa.array([whole.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    sums = chosen.select("text").mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect()
    counts = np.zeros((PARTS, (1 << SLOTS) // PARTS))
    for row in sums:
        counts[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return np.floor(4 * np.log2(counts.ravel() + 1)).astype(np.uint8)


def prefix(shingles: np.ndarray, levels: np.ndarray, least: float) -> np.ndarray:
    """The shingles of a set of which any set that similar has one among its own."""
    if not len(shingles):
        return shingles
    order = np.lexsort((shingles, levels[_slots(shingles)]))
    return shingles[order[: len(shingles) - math.ceil((least - SPARE) * len(shingles)) + 1]]


def signature(shingles: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The parities of the buckets of a set, 64 in each of ``words`` signed longs."""
    odd = np.bincount((shingles & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def prints(chosen: DataFrame, least: float = LEAST) -> DataFrame:
    """(id, class, fp, size, bits, wide, prefix) for every row of (id, text); wide is null up to `LARGE`."""
    levels = slot_levels(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for t in part.column(1):
                    t = t.as_py()
                    hashes = simhash.shingle_hashes(t, SHINGLE)
                    sets = np.unique(hashes)
                    out.append((class_of(t), simhash.majority(hashes), len(sets), signature(sets), signature(sets, WIDE) if len(sets) > LARGE else None, prefix(sets, levels, least).view("<i8")))
                fps = np.array([o[1] for o in out], dtype="<u8").view("<i8")
                longs = pa.list_(pa.int64())
                yield pa.record_batch(
                    [part.column(0), pa.array([o[0] for o in out], pa.int64()), pa.array(fps, pa.int64()), pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], longs), pa.array([o[4] for o in out], longs), pa.array([o[5] for o in out], longs)],
                    names=["id", "class", "fp", "size", "bits", "wide", "prefix"],
                )

    return chosen.mapInArrow(run, "id long, class long, fp long, size int, bits array<long>, wide array<long>, prefix array<long>")


def _flags(members: DataFrame) -> np.ndarray:
    """A bit for each of 2 ** `FLAGS` slots of hashes of ids, set if some member's id falls into it."""
    slot = members.select(F.shiftrightunsigned(F.xxhash64("id"), 64 - FLAGS).alias("slot"))
    words = slot.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")).toArrow()
    flags = np.zeros(1 << FLAGS - 6, "<i8")
    flags[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return flags.view(np.uint8)


def _flagged_sets(chosen: DataFrame, flags: np.ndarray) -> DataFrame:
    """(class, id, shingles) for the rows whose ids have a flag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            at = batch.column(2).to_numpy().view(np.uint64) >> np.uint64(64 - FLAGS)
            rows = np.flatnonzero(flags[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1)
            for k in range(0, len(rows), 256):
                part = batch.take(pa.array(rows[k : k + 256]))
                texts = part.column(1).to_pylist()
                sets = [np.unique(simhash.shingle_hashes(t, SHINGLE)).view("<i8") for t in texts]
                yield pa.record_batch([pa.array([class_of(t) for t in texts], pa.int64()), part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["class", "id", "shingles"])

    return chosen.select("id", "text", F.xxhash64("id").alias("slot")).mapInArrow(run, "class long, id long, shingles array<long>")


def shingle_sets(chosen: DataFrame, members: DataFrame) -> DataFrame:
    """(class, shingles) for each of ``members`` (class, id), from a row of its id.

    Sets of other rows are not worked out, but for the few whose ids share a slot with a
    member's; these are left out after.
    """
    some = _flagged_sets(chosen, _flags(members))
    return some.join(members, ["class", "id"], "left_semi").select("class", "shingles").dropDuplicates(["class"])


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Those of the candidate pairs (a, b) whose sets are similar enough."""
    x, y = (sets.select(F.col("class").alias(n), F.col("shingles").alias(f"s{n}")) for n in "ab")
    both = pairs.join(x, "a").join(y, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    whole = F.size("sa") + F.size("sb") - common
    return both.where(common >= whole * (least - SPARE)).select("a", "b")


def _bound(m: F.Column, n: F.Column, least: float) -> F.Column:
    """The most elements in which similar sets of these sizes differ."""
    return (m + n) * ((1 - least + SPARE) / (1 + least - SPARE)) + 1e-6


def _edges(pairs: DataFrame, wide: DataFrame, chosen: DataFrame, found: DataFrame, least: float) -> DataFrame:
    x, y = (wide.select(F.col("class").alias(n), F.col("size").alias(f"n{n}"), F.col("wide").alias(f"w{n}")) for n in "ab")
    apart = F.aggregate(F.zip_with("wa", "wb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)
    may = F.coalesce(apart <= _bound(F.col("na"), F.col("nb"), least), F.lit(True))
    pairs = materialize(pairs.join(x, "a", "left").join(y, "b", "left").where(may).select("a", "b"), "near-pairs")
    classes = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    members = found.select("class", "id").join(classes, "class", "left_semi").groupBy("class").agg(F.min("id").alias("id"))
    sets = materialize(shingle_sets(chosen, materialize(members, "near-members")), "near-sets")
    return materialize(_verified(pairs, sets, least), "near-edges")


def _may_link(x: str, y: str, least: float) -> F.Column:
    """Whether the sizes and signatures of the rows ``x`` and ``y`` allow the similarity."""
    m, n, bar = F.col(f"{x}.size"), F.col(f"{y}.size"), least - SPARE
    apart = sum(F.bit_count(F.col(f"{x}.bits")[k].bitwiseXOR(F.col(f"{y}.bits")[k])) for k in range(WORDS))
    return (m >= n * bar) & (n >= m * bar) & (apart <= _bound(m, n, least))


def _stars(found: DataFrame) -> DataFrame:
    """(key, class, low): members of lists of two or more, with the head of their list.

    The head is drawn by a hash, so that a member that is not like some other, which heads
    one list, meets another in the next.
    """
    posting = found.select("class", "prefix").dropDuplicates(["class"]).select("class", F.explode("prefix").alias("key")).repartition("key")
    head = F.min(F.struct(F.xxhash64("key", "class").alias("h"), F.col("class")))["class"]
    lists = posting.groupBy("key").agg(F.count(F.lit(1)).alias("n"), head.alias("low")).where("n > 1").drop("n")
    return materialize(posting.join(lists, "key"), "near-postings")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def _rest(stars: DataFrame, signs: DataFrame, parts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of a list that are in different components and may be similar."""
    placed = stars.select("key", "class").join(parts, "class", "left").select("key", "class", F.coalesce("component", "class").alias("part"))
    torn = placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("key")
    keys = placed.join(torn, "key", "left_semi").groupBy("class", "part").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    rows = keys.join(signs, "class").select("class", "part", "size", "bits", "keys", F.posexplode("keys").alias("at", "key"))
    back = F.slice("keys", F.greatest(F.col("at") - BACK, F.lit(0)) + 1, F.least("at", F.lit(BACK)))
    rows = materialize(rows.select("key", "class", "part", "size", "bits", back.alias("back")), "near-rest")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.class") > F.col("y.class")) & (F.col("x.part") != F.col("y.part"))
    # A pair is left out only where it has met in one of the lists before.
    new = ~F.arrays_overlap("x.back", "y.back")
    return rows.alias("x").join(rows.alias("y"), met & _may_link("x", "y", least) & new).select(F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()


def components(chosen: DataFrame, found: DataFrame, least: float = LEAST, pair_bound: int = 64) -> DataFrame:
    """(class, component) for every class of ``found`` (the `prints` of ``chosen``) that has a link."""
    signs = materialize(found.select("class", "fp", "size", "bits").dropDuplicates(["class"]), "near-signs")
    wide = materialize(found.where(F.col("size") > LARGE).select("class", "size", "wide").dropDuplicates(["class"]), "near-wide")
    stars = _stars(found)
    low = signs.groupBy("fp").agg(F.min("class").alias("rep"))
    same = signs.select("class", "fp").join(low, "fp")
    bits = simhash.links(materialize(low, "near-classes"), pair_bound, 2)
    first = _pairs(stars, "class", "low").unionByName(_pairs(same, "class", "rep")).unionByName(_pairs(bits, "a", "b")).distinct()
    both = first.join(signs.alias("x"), F.col("a") == F.col("x.class")).join(signs.alias("y"), F.col("b") == F.col("y.class"))
    first = both.where(_may_link("x", "y", least)).select("a", "b")
    edges = _edges(first, wide, chosen, found, least)
    parts = materialize(connected_components(edges).withColumnRenamed("node", "class"), "near-parts")
    more = _edges(_rest(stars, signs, parts, least), wide, chosen, found, least)
    return materialize(connected_components(edges.unionByName(more)).withColumnRenamed("node", "class"), "near-parts")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, pair_bound: int = 64) -> DataFrame:
    """(id, class, component, kept) for every distinct id and class; the least id of a component is kept."""
    chosen = _chosen(docs, id_col, text_col)
    found = materialize(prints(chosen, least), "near-prints")
    parts = components(chosen, found, least, pair_bound)
    nodes = found.select("id", "class").distinct().join(parts, "class", "left").withColumn("component", F.coalesce("component", "class"))
    nodes = materialize(nodes, "near-nodes")
    heads = nodes.groupBy("component").agg(F.min(F.struct("id", "class")).alias("head"))
    return nodes.join(heads, "component").select("id", "class", "component", (F.struct("id", "class") == F.col("head")).alias("kept"))
