"""SimHash near-dedup through a byte-position inverted index with count filtering.

A fingerprint has eight positional bytes. Two fingerprints at Hamming distance k <= 2
differ in at most two of them, so they share at least six. Posting lists of one positional
byte would hold 1/256 of the corpus each, so the index posts *sets* of four positional
bytes: six of these cover every way to lose two bytes when bytes are paired up, and a pair
that shares six bytes shares at least one of them. Each pair that meets in a list is
tallied over all eight positions, kept from the first common list only if the tally
reaches the guaranteed minimum, and then verified on its bits.

A list longer than ``pair_bound`` (groups of near copies) emits no pairs at all. Its
members are linked exactly through radius-1 balls: two fingerprints are within two bits
if and only if the sets {f} + {f with one bit flipped} meet, so each member posts 65 keys
and is tied to the least document of every key. That is linear in the group and loses
no link.

Defined cases: a null or empty text, or one without words, has fingerprint zero and links
like any other; rows with a null id get a fingerprint and a null component and link with
nothing; repeated ids are separate rows of one node; an empty table gives an empty result;
other columns of the input are not read, so their names may clash with ours.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, worker_cache
from grainmill.llm.graph import connected_components

SEED = 42
#: Bit counting works through so many shingles at a time.
BLOCK = 1 << 15


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """The hashes of a text's word shingles; a shorter text is one shingle, one without words has none."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    if len(words) < shingle:
        pieces, n = iter([b" ".join(words)]), 1
    else:
        pieces, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), dtype="<u8", count=n)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = np.ascontiguousarray(hashes[i : i + BLOCK]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit SimHash of one text."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp) with the fingerprint's bits in a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype="<u8").view("<i8")
            yield pa.record_batch([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "id long, fp long")


def _block(i: int) -> F.Column:
    return F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))


_PAIRS = [(i, j) for i in range(4) for j in range(i + 1, 4)]


def links(classes: DataFrame, pair_bound: int = 64, bits: int = 2) -> DataFrame:
    """Edges (a, b) between the representatives of ``classes`` (fp, rep) within ``bits`` bits.

    The edges connect exactly what the full link graph connects.
    """
    if not 0 <= bits <= 2:
        raise ValueError("the index guarantees six shared bytes for at most two bits")
    posted = F.array(*[F.lit(k << 32).bitwiseOR(F.shiftleft(_block(i), 16)).bitwiseOR(_block(j)) for k, (i, j) in enumerate(_PAIRS)])
    posting = classes.select("fp", "rep", F.explode(posted).alias("key"))
    lists = posting.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    posting = materialize(posting.join(lists, "key"), "postings")

    x, y = posting.where(F.col("n") <= pair_bound).alias("x"), posting.where(F.col("n") <= pair_bound).alias("y")
    diff = F.col("x.fp").bitwiseXOR(F.col("y.fp"))
    tally = sum((F.shiftrightunsigned(diff, 8 * k).bitwiseAND(F.lit(255)) == 0).cast("int") for k in range(8))
    same = [F.shiftrightunsigned(diff, 16 * i).bitwiseAND(F.lit(0xFFFF)) == 0 for i in range(4)]
    first = F.coalesce(*[F.when(same[i] & same[j], F.lit(k)) for k, (i, j) in enumerate(_PAIRS)])
    cold = x.join(
        y,
        (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & (tally >= 8 - bits) & (first == F.shiftrightunsigned("x.key", 32)) & (F.bit_count(diff) <= bits),
    ).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    radius = {0: F.array("fp"), 1: F.array("fp"), 2: flips}[bits]
    crowded = posting.where(F.col("n") > pair_bound).select("fp", "rep").distinct()
    if bits == 1:  # balls of radius 1/2: edges of the cube, named by the lower end and the bit
        radius = F.array(*[F.struct(F.col("fp").bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)).alias("l"), F.lit(i).alias("i")) for i in range(64)])
    balls = crowded.select("rep", F.explode(radius).alias("ball"))
    centre = balls.groupBy("ball").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    hot = balls.join(centre, "ball").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    return cold.unionByName(hot)


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2, pair_bound: int = 64) -> DataFrame:
    """(id, fp, component_id, kept): one row per input row; see the module's defined cases."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = materialize(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("rep")), "classes")
    parts = connected_components(links(classes, pair_bound, bits)).withColumnRenamed("node", "rep")
    named = classes.join(parts, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        "id", "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"), F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
