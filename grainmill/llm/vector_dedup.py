"""Embedding near-dedup: an exact metric range join.

Cosine >= c on unit vectors is Euclidean distance <= r with r = sqrt(2 - 2c). Pivots are
drawn for every group (label and dimension) that is larger than a cell should be. Each
vector's home is the cell of its nearest pivot. A vector y of home j can be within r of
a vector of cell i only if

    d(y, p_i) - d(y, p_j) <= 2r                             (triangle inequality)
    (d(y, p_i)^2 - d(y, p_j)^2) / (2 d(p_i, p_j)) <= r      (y's distance from the border)

and is replicated to those cells. Each cell then counts, on its own, the links of its home
vectors to everything it holds, so each vector's links are counted in one cell and every
link is found. Rows of large cells are dealt to blocks, and each pair of blocks is a group
of its own: a task holds two blocks at most, whatever the size of a cell. A block pair
reports per vector a count and the least member of its connected part, never pairs.

Equal vectors of a label are one class with a number of its own: classes are grouped before
the join, counted by weight and spread again afterwards. Ids only serve to name components.

Cosines are dot products of vectors scaled to unit length in double precision; where one is
within `CLOSE` of the threshold, it is summed again without rounding between, so that all
blocks agree on a pair.

Memory of a task: `PLACED` distances at a time while cells are found, two blocks while they
are compared.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and
those with a null label, link with nothing and stay on their own; vectors of different
lengths never link; rows with a null id keep n_links 0 and a null component and are nobody's
neighbour; rows that repeat an id are vectors of their own, each with its own links (to each
other, too), in one component; labels of any type are equal if their texts are; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, worker_cache
from grainmill.llm.graph import connected_components

#: Above the rounding of distances; replication errs on the side of one cell too many.
SLACK = 1e-7
#: Distance from the threshold below which a cosine is summed exactly; distances to pivots held at a time.
CLOSE, PLACED = 1e-9, 1 << 21


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length, safe for components whose squares over- or underflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(batch: pa.RecordBatch, column: int) -> list[np.ndarray]:
    return [np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64) for v in batch.column(column)]


def _draw_pivots(classes: DataFrame, cell_rows: int, max_pivots: int) -> dict[tuple[str, int], np.ndarray]:
    """Unit pivots of each group with more than ``cell_rows`` classes; about n / cell_rows, at most twice ``max_pivots``."""
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    if not total:
        return {}
    per = max(cell_rows, math.ceil(total / max_pivots))
    grain = 1 << 40
    share = F.pmod(F.xxhash64("k2", "k1"), F.lit(grain)) < (F.lit(float(grain)) * 1.0 / per).cast("long")
    drawn = classes.where(share).join(sizes.select("label", "dim"), ["label", "dim"], "left_semi").orderBy("k1", "k2").limit(2 * max_pivots).select("label", "dim", "vec").collect()
    pivots: dict[tuple[str, int], list] = {}
    for r in drawn:
        pivots.setdefault((r["label"], r["dim"]), []).append(r["vec"])
    return {g: unit(np.array(v, dtype=np.float64)) for g, v in pivots.items()}


def assign_cells(labels: list[str], vectors: list[np.ndarray], pivots: dict, radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) for each place that each row takes."""
    rows, cells, homes = [], [], []
    keys = [(label, len(v)) for label, v in zip(labels, vectors, strict=True)]
    groups: dict[tuple[str, int], list[int]] = {}
    for i, k in enumerate(keys):
        groups.setdefault(k, []).append(i)
    for k, members in groups.items():
        p = pivots.get(k)
        at = np.array(members)
        if p is None:
            rows.append(at)
            cells.append(np.zeros(len(at), dtype=np.int64))
            homes.append(np.ones(len(at), dtype=bool))
            continue
        u = unit(np.stack([vectors[i] for i in members]))
        square = np.maximum(2 - 2 * (u @ p.T), 0.0)
        apart = np.sqrt(np.maximum(2 - 2 * (p @ p.T), 0.0))
        home = square.argmin(axis=1)
        own = square[np.arange(len(at)), home][:, None]
        near = (np.sqrt(square) - np.sqrt(own) <= 2 * radius + SLACK) & (square - own <= 2 * apart[home] * radius + SLACK)
        near[np.arange(len(at)), home] = True
        r, c = np.nonzero(near)
        rows.append(at[r])
        cells.append(c.astype(np.int64))
        homes.append(c == home[r])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return np.concatenate(rows), np.concatenate(cells), np.concatenate(homes)


def block_links(home: np.ndarray, home_id: np.ndarray, other: np.ndarray, other_id: np.ndarray, weight: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links of each home row by weight, least number of its part, that of each other row)."""
    products = home @ other.T
    near = products >= cosine
    for i, j in zip(*np.nonzero(np.abs(products - cosine) < CLOSE), strict=True):
        near[i, j] = math.fsum(home[i] * other[j]) >= cosine
    near &= home_id[:, None] != other_id[None, :]
    links = near @ weight
    low_h, low_o = home_id.copy(), other_id.copy()
    i, j = np.nonzero(near)
    while len(i):
        before = (low_h.copy(), low_o.copy())
        np.minimum.at(low_h, i, low_o[j])
        np.minimum.at(low_o, j, low_h[i])
        if (low_h == before[0]).all() and (low_o == before[1]).all():
            break
    return links, low_h, low_o


def range_join(classes: DataFrame, cosine: float, cell_rows: int, max_pivots: int, block_rows: int) -> DataFrame:
    """(no, links, low) facts; sums of links by class number are complete, and (no, low) edges connect what links connect."""
    spark = classes.sparkSession
    radius = math.sqrt(max(0.0, 2 - 2 * cosine))
    pivots = spark.sparkContext.broadcast(_draw_pivots(classes, cell_rows, max_pivots))

    widest = max((len(p) for p in pivots.value.values()), default=1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for whole in batches:
            for at in range(0, whole.num_rows, max(16, PLACED // widest)):
                batch = whole.slice(at, max(16, PLACED // widest))
                vectors = _matrix(batch, 3)
                rows, cells, homes = assign_cells(batch.column(0).to_pylist(), vectors, pivots.value, radius)
                scaled = pa.array([unit(v[None, :])[0].tobytes() for v in vectors], pa.binary())
                for i in range(0, len(rows), 20_000):
                    r = pa.array(rows[i : i + 20_000])
                    yield pa.record_batch([batch.column(0).take(r), batch.column(1).take(r), pa.array(cells[i : i + 20_000]), pa.array(homes[i : i + 20_000]), batch.column(2).take(r), batch.column(4).take(r), scaled.take(r)], names=["label", "dim", "cell", "home", "no", "weight", "vec"])

    placed = classes.select("label", "dim", "no", "vec", "weight").mapInArrow(place, "label string, dim int, cell long, home boolean, no long, weight long, vec binary")
    placed = materialize(placed, "cells")
    cell = ["label", "dim", "cell"]
    sizes = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("home")).alias("m"))
    # Cells of one row have nothing to compare; cells of up to a block are one group.
    sizes = sizes.where("n > 1 and m > 0").select(*cell, F.ceil(F.col("m") / block_rows).cast("int").alias("homes"), F.ceil(F.col("n") / block_rows).cast("int").alias("all"))
    dealt = placed.join(sizes, cell)
    slot = F.pmod(F.xxhash64("no"), F.lit(1 << 30))
    as_other = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda h: F.struct(h.alias("h"), (slot % F.col("all")).cast("int").alias("o"), F.lit(False).alias("left")))
    as_home = F.transform(F.sequence(F.lit(0), F.col("all") - 1), lambda o: F.struct((slot % F.col("homes")).cast("int").alias("h"), o.alias("o"), F.lit(True).alias("left")))
    dealt = dealt.select(*cell, "no", "weight", "vec", F.explode(F.when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)).alias("b")).select(*cell, "b.*", "no", "weight", "vec")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        left, right = group[group["left"]], group[~group["left"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"no": [], "links": [], "low": []}, dtype="int64")
        stack = lambda part: np.frombuffer(b"".join(part["vec"]), dtype=np.float64).reshape(len(part), -1)
        hid, oid = left["no"].to_numpy(), right["no"].to_numpy()
        links, low_h, low_o = block_links(stack(left), hid, stack(right), oid, right["weight"].to_numpy(), cosine)
        keep_h, keep_o = links > 0, low_o != oid
        return pd.DataFrame({"no": np.concatenate([hid[keep_h], oid[keep_o]]), "links": np.concatenate([links[keep_h], np.zeros(keep_o.sum(), np.int64)]), "low": np.concatenate([low_h[keep_h], low_o[keep_o]])})

    return dealt.groupBy(*cell, "h", "o").applyInPandas(compare, "no long, links long, low long")


def vector_dedup(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98, cell_rows: int = 1000, max_pivots: int = 4096, block_rows: int = 2048
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row; see the module's defined cases."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = F.coalesce(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"), vec.alias("vec"), good.alias("good"))
    keyed = rows.withColumns({"k1": F.when(F.col("good"), F.xxhash64("vec")), "k2": F.when(F.col("good"), F.xxhash64(F.reverse("vec"), F.size("vec"))), "dim": F.size("vec")})
    key = ["label", "dim", "k1", "k2"]
    classes = keyed.where("good").groupBy(*key).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.first("vec").alias("vec"))
    # Numbers are fixed by being written.
    classes = materialize(classes.withColumn("no", F.monotonically_increasing_id()), "vectors")
    facts = materialize(range_join(classes, cosine, cell_rows, max_pivots, block_rows), "links")
    heads = classes.select("no", "rep")
    edges = facts.where("no <> low").select("no", "low").join(heads, "no").withColumnRenamed("rep", "a").join(heads.select(F.col("no").alias("low"), F.col("rep").alias("b")), "low").select("a", "b")
    # An id in several classes ties them to each other.
    ids = materialize(keyed.select("id", *key).join(classes.select(*key, "no", "rep", "weight"), key, "left").select("id", "no", "rep", "weight"), "vector-ids")
    several = ids.groupBy("id").agg(F.min("no").alias("p"), F.max("no").alias("q")).where("p <> q").select("id")
    shared = ids.join(several, "id", "left_semi").where("rep is not null").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    parts = connected_components(edges.unionByName(shared)).withColumnRenamed("node", "rep")
    counts = facts.groupBy("no").agg(F.sum("links").alias("links"))
    named = heads.join(counts, "no", "left").join(parts, "rep", "left").select("no", "links", F.coalesce("component", "rep").alias("component"))
    out = ids.join(named, "no", "left")
    component = F.coalesce("component", "id").alias("component_id")
    return out.select("id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"), component, F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))
