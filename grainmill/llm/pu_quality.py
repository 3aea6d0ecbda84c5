"""Quality classifier by positive-unlabelled learning.

A text becomes surface features (case, symbols, repetition, layout, word shape), each cut
into bins at quantiles, and an additive model of the bins is fitted by minimising the
non-negative unbiased risk

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

with the logistic loss, so the model's sigmoid estimates the chance of label 1. Trusted
positives are labelled rows, the unlabelled text is documents without a label; labelled
negatives serve only to estimate the class prior (the positive share of all labelled
training rows; the histogram-ratio bound of `ratio_prior` where there are no negatives).

The fit uses at most ``sample_bound`` labelled positives, picked by a hash of the id. Bins are
cut at quantiles of all rows of the fit, and the unlabelled side of the risk is summed over
all unlabelled rows: Adam runs ``rounds`` rounds on a sample of them for a start and
``passes`` rounds on all of them, each of which sums the gradient by bin over a table of bin
numbers. Features are computed
once per document in Arrow batches and written to the shared folder, so the text is read
once and never shuffled; labels meet the short feature rows. A very long text is measured
as a whole, in memory of about twenty times its size.

Defined cases: null texts count as empty, and empty texts get a score like any other; ids
that are null or have labels that disagree are never trained on; repeated ids are scored as
separate rows; without any positive, or with an empty table, the score is ``prior`` or
there are no rows; labels with a null quality are ignored; other columns are not read.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import materialize, worker_cache

FEATURES = ("log_words", "upper", "digit", "symbol", "bang", "bar", "stops", "space", "lines", "distinct", "echo", "dup_lines", "word_len", "word_dev", "non_ascii", "tail_symbol", "capitalised", "short_line")
_DIGITS, _SYMBOLS, _STOPS = b"0123456789", b"#*$%&|<>@^~{}[]\\_=+", b".,;:?"
#: Quantiles that cut a feature into bins.
GRID = (0.001, 0.005, 0.02, 0.05, *(k / 12 for k in range(1, 12)), 0.95, 0.98, 0.995, 0.999)
_LIST = "id long, features array<float>"


def features(text: str | None) -> list[float]:
    """The surface features of one text, in the order of FEATURES."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    n = max(1, len(raw))
    words = text.split()
    k = max(1, len(words))
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    code = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    low = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    upper = float((code != low).mean()) if len(code) and len(code) == len(low) else float(sum(map(str.isupper, text))) / n
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words))
    share = lambda cut: (len(raw) - len(raw.translate(None, cut))) / n
    return [
        float(np.log1p(len(words))), upper, share(_DIGITS), share(_SYMBOLS), share(b"!"), share(b"|"), share(_STOPS), share(b" \t\r\n\x0b\x0c"), len(lines) / k,
        len(set(words)) / k, sum(map(operator.eq, words, words[1:])) / k, (len(lines) - len(set(lines))) / max(1, len(lines)),
        float(sizes.mean()) if len(words) else 0.0, float(sizes.std()) if len(words) else 0.0, float((code > 127).mean()) if len(code) else 0.0,
        sum(1 for w in words if w[-1] in "#*$%&|<>!") / k, sum(1 for w in words if w[0].isupper()) / k, sum(1 for x in lines if len(x) < 25) / max(1, len(lines)),
    ]


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            rows = np.array([features(t.as_py()) for t in batch.column(1)], dtype=np.float32).reshape(-1, len(FEATURES))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)), pa.array(rows.ravel()))
            yield pa.record_batch([batch.column(0), flat], names=["id", "features"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _LIST)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


@dataclass
class Model:
    """edges: bin limits of each feature; weights: one per bin; prior: the class prior."""

    edges: list[np.ndarray]
    weights: list[np.ndarray]
    bias: float
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        g = np.full(len(rows), self.bias)
        for j, (cut, w) in enumerate(zip(self.edges, self.weights, strict=True)):
            g += w[np.searchsorted(cut, rows[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(g, -40, 40)))


def ratio_prior(pos: np.ndarray, unl: np.ndarray, cells: int = 10) -> float:
    """A bound on the class prior: the least ratio of unlabelled to positive density over any feature's bins."""
    best = 1.0
    for j in range(pos.shape[1]):
        cut = np.unique(np.quantile(pos[:, j], np.linspace(0, 1, cells + 1)[1:-1]))
        p = np.bincount(np.searchsorted(cut, pos[:, j], side="right"), minlength=len(cut) + 1) / len(pos)
        u = np.bincount(np.searchsorted(cut, unl[:, j], side="right"), minlength=len(cut) + 1) / len(unl)
        best = min([best, *(u[p > 0.03] / p[p > 0.03])])
    return float(np.clip(best, 0.05, 0.95))


def class_prior(pos: np.ndarray, unl: np.ndarray, prior: float | None) -> float:
    return ratio_prior(pos, unl) if prior is None else float(np.clip(prior, 0.01, 0.99))


def indexed(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each feature among the bins of all features, in a row for each row."""
    starts = np.cumsum([0, *(len(e) + 1 for e in edges[:-1])])
    return np.stack([s + np.searchsorted(e, rows[:, j], side="right") for j, (s, e) in enumerate(zip(starts, edges, strict=True))], axis=1)


def _gather(at: np.ndarray, by: np.ndarray, width: int) -> np.ndarray:
    """Sums of ``by`` by bin, and its sum."""
    return np.append(np.bincount(at.ravel(), weights=np.repeat(by, at.shape[1]), minlength=width), by.sum())


def _chance(at: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(w[at].sum(1) + w[-1], -40, 40)))


def unlabelled_part(at: np.ndarray, w: np.ndarray, width: int) -> np.ndarray:
    """Sums over rows of the gradient of l(-g) by bin and for the bias, then of l(-g) itself and of rows."""
    s = _chance(at, w)
    return np.append(_gather(at, s, width), [-np.log(1 - s + 1e-12).sum(), len(s)])


def risk(w: np.ndarray, at: np.ndarray, unlabelled: np.ndarray, prior: float, decay: float) -> tuple[float, np.ndarray]:
    """The non-negative risk and the direction to leave; ``at`` are the positives, ``unlabelled`` sums as above.

    The direction is the gradient; where the estimated negative risk falls below zero, it is
    that of the negative risk turned round, which leads back out.
    """
    width = len(w) - 1
    s = _chance(at, w)
    n = unlabelled[-1]
    negative = unlabelled[-2] / n + prior * np.log(1 - s + 1e-12).mean()
    up = _gather(at, prior * (s - 1) / len(s), width)
    down = unlabelled[:-2] / n - _gather(at, prior * s / len(s), width)
    value = prior * -np.log(s + 1e-12).mean() + max(0.0, negative) + decay / 2 * float(w[:-1] @ w[:-1])
    return value, (up + down if negative >= 0 else -down) + decay * np.append(w[:-1], 0.0)


def adam(w: np.ndarray, direction: Callable[[np.ndarray], np.ndarray], rounds: int, rate: float) -> np.ndarray:
    m, v = np.zeros(len(w)), np.zeros(len(w))
    for t in range(1, rounds + 1):
        d = direction(w)
        m, v = 0.9 * m + 0.1 * d, 0.999 * v + 0.001 * d * d
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return w


def held_out(id_col: str = "id") -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _sampled(rows: DataFrame, column: str, bound: int) -> list:
    """At most ``bound`` values, of the rows with the least hashes of the id: the same rows in any run."""
    n = rows.count()
    mark = F.pmod(F.xxhash64("id", column), F.lit(1 << 62))
    if n > bound:
        rows = rows.where(mark < int((1 << 62) * min(1.0, 1.5 * bound / n + 1000 / n)))
    return [r[0] for r in rows.select(column, mark.alias("mark")).orderBy("mark").limit(bound).collect()]


def _bin_edges(rows: DataFrame) -> list[np.ndarray]:
    """Quantiles of every feature over all rows."""
    wanted = F.array(*map(F.lit, GRID))
    cuts = rows.agg(*[F.percentile_approx(F.col("features")[j].cast("double"), wanted, F.lit(10_000)).alias(f"f{j}") for j in range(len(FEATURES))]).first()
    return [np.unique(np.array(c or [], dtype=np.float64)) for c in cuts]


def train(
    table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", sample_bound: int = 20_000, prior: float | None = None, decay: float = 1e-6, rounds: int = 1500, rate: float = 0.1, passes: int = 12, last_rate: float = 0.02
) -> Model:
    """Fit on rows outside the held-out fold; see the module for what is learnt from."""
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null").where(~held_out())
    marks = marks.groupBy("id").agg(F.min("y").alias("lo"), F.max("y").alias("hi"))
    known = table.where("id is not null").where(~held_out()).join(marks, "id", "left")
    known = materialize(known, "pu-train")
    counts = marks.agg(F.count_if(F.col("lo") == 1).alias("p"), F.count_if(F.col("hi") == 0).alias("n")).first()
    if prior is None and counts["n"]:
        prior = (counts["p"] + 1) / (counts["p"] + counts["n"] + 2)
    matrix = lambda got: np.array(got, dtype=np.float64).reshape(-1, len(FEATURES))
    pos = matrix(_sampled(known.where("lo = 1"), "features", sample_bound))
    unlabelled = known.where("lo is null")
    unl = matrix(_sampled(unlabelled, "features", sample_bound))
    if not len(unl):
        unlabelled = known
        unl = matrix(_sampled(known, "features", sample_bound))
    if not len(pos) or not len(unl):
        prior = prior or 0.5
        return Model([np.array([])] * len(FEATURES), [np.zeros(1)] * len(FEATURES), float(np.log(prior / (1 - prior))), prior)
    prior = class_prior(pos, unl, prior)
    edges = _bin_edges(unlabelled.select("features").unionByName(known.where("lo = 1").select("features")))
    sizes = [len(e) + 1 for e in edges]
    width = sum(sizes)
    at, au = indexed(pos, edges), indexed(unl, edges)
    start = np.append(np.zeros(width), np.log(prior / (1 - prior)))
    w = adam(start, lambda w: risk(w, at, unlabelled_part(au, w, width), prior, decay)[1], rounds, rate)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = indexed(_matrix(batch.column(0)), edges).astype("<u2")
            yield pa.record_batch([pa.array([r.tobytes() for r in rows], pa.binary())], names=["bins"])

    bins = materialize(unlabelled.select("features").mapInArrow(code, "bins binary"), "pu-bins")

    def on_all(w: np.ndarray) -> np.ndarray:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width + 3)
            for batch in batches:
                rows = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u2").reshape(-1, len(FEATURES)).astype(np.int64)
                total += unlabelled_part(rows, w, width)
            yield pa.record_batch([pa.array(np.arange(width + 3)), pa.array(total)], names=["k", "x"])

        # One row for each bin from each task, summed before and after the shuffle.
        sums = dict(bins.mapInArrow(part, "k long, x double").groupBy("k").agg(F.sum("x")).collect())
        return risk(w, at, np.array([sums[k] for k in range(width + 3)]), prior, decay)[1]

    w = adam(w, on_all, passes, last_rate)
    cuts = np.cumsum(sizes)[:-1]
    return Model(edges, np.split(w[:-1], cuts), float(w[-1]), prior)


def score(table: DataFrame, model: Model) -> DataFrame:
    """(id, score) for every row of a feature table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(model.score(rows))], names=["id", "score"])

    return table.mapInArrow(run, "id long, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, sample_bound: int = 20_000) -> DataFrame:
    """(id, held_out, score, predicted) for every row of ``docs``."""
    table = materialize(feature_table(docs, id_col, text_col), "pu-features")
    model = train(table, labels, id_col, label_col, sample_bound)
    return score(table, model).select("id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_predicted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.3, sample_bound: int = 20_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``."""
    table = materialize(feature_table(docs, id_col, text_col), "pu-features")
    model = train(table, labels, id_col, label_col, sample_bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            rows = np.array([features(t.as_py()) for t in texts], dtype=np.float32).reshape(-1, len(FEATURES)).astype(np.float64)
            yield batch.filter(pa.array(model.score(rows) >= threshold))

    return docs.mapInArrow(run, docs.schema)
