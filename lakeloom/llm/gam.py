"""Quality classifier: a generalised additive model with pairwise interactions, boosted into lookup tables."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE, chunks, row_counts, span_hashes, spans, table, text_of

#: Labelled rows that a model is fitted on at most.
SAMPLE_ROWS = 20_000
FEATURES = ("log_bytes", "words", "mean_word", "upper", "digits", "punctuation", "symbols", "bars", "multibyte", "space",
            "sentence_marks", "distinct_words", "top_word", "lines_per_word", "distinct_lines", "repeat_next", "long_words", "one_mark_words")

_KIND = np.zeros(256, np.int8)  # 0 other letters, then classes below
_CLASSES = {1: range(65, 91), 2: range(48, 58), 3: map(ord, ".,;:'\"()-?"), 4: map(ord, "#$%&*+<=>@[]^_`{}~\\/!"), 5: map(ord, "|"),
            6: range(128, 256), 7: (9, 10, 11, 12, 13, 32)}
for _k, _bytes in _CLASSES.items():
    _KIND[list(_bytes)] = _k
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[33, 46, 63]] = True


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _distinct(codes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in each row and how often the most frequent one stands there."""
    order = np.lexsort((codes, rows))
    codes, rows = codes[order], rows[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(codes)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, rows[at], size)
    return np.bincount(rows[at], minlength=n), top


def text_features(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text; ratios of an empty text are 0."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    kind = _KIND[data]
    count = [_per_row(kind == k, offsets) for k in range(8)]
    starts, ends = spans(data, offsets)
    words = row_counts(starts, offsets)
    of_word = np.repeat(np.arange(n), words)
    codes = span_hashes(data, starts, ends)
    different, top = _distinct(codes, of_word, n)
    lines = np.flatnonzero(data == 10)
    begin = np.union1d(offsets[:-1][size > 0], lines + 1)
    begin = begin[begin < (offsets[-1] if n else 0)]
    end = np.append(begin[1:], offsets[-1] if n else 0)[:len(begin)]
    end = end - (data[end - 1] == 10) if len(end) else end
    of_line = np.searchsorted(offsets, begin, "right") - 1
    full = end > begin
    per_line = np.bincount(of_line[full], minlength=n)
    lines_different, _ = _distinct(span_hashes(data, begin[full], end[full]), of_line[full], n)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (of_word[1:] == of_word[:-1])
    width = ends - starts
    marks = kind[ends - 1] == 4 if len(ends) else np.zeros(0, bool)
    ratio = lambda a, b: a / np.maximum(b, 1)
    return np.stack([
        np.log1p(size), np.log1p(words), ratio(_row_sum(width, of_word, n), words), ratio(count[1], size), ratio(count[2], size),
        ratio(count[3], size), ratio(count[4], size), ratio(count[5], words), ratio(count[6], size), ratio(count[7], size),
        ratio(_per_row(_SENTENCE[data], offsets), words), ratio(different, words), ratio(top, words), ratio(per_line, words),
        ratio(lines_different, per_line), ratio(_row_sum(same, of_word, n), words), ratio(_row_sum(width > 12, of_word, n), words),
        ratio(_row_sum(marks, of_word, n), words),
    ], 1)


def _row_sum(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, values, minlength=n)


@dataclass
class AdditiveModel:
    """score = sigmoid(base + one table per feature + one table per pair of features)."""

    cuts: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], "right") for k, c in enumerate(self.cuts)], 1)

    def logit(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for k, lookup in enumerate(self.tables):
            out += lookup[bins[:, k]]
        for (a, b), lookup in self.pairs.items():
            out += lookup[bins[:, a], bins[:, b]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(self.bins(x)), -30, 30)))


def _tree(grad: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """A shallow regression tree over ordered bins: a step per bin, from the best ``leaves`` - 1 cuts."""
    parts = [(0, len(grad))]
    g, w = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(weight)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + ridge)
    for _ in range(leaves - 1):
        best = (1e-9, None, None)
        for at, (a, b) in enumerate(parts):
            if b - a > 1:
                c = np.arange(a + 1, b)
                more = gain(a, c) + gain(c, b) - gain(a, b)
                k = int(more.argmax())
                if more[k] > best[0]:
                    best = (more[k], at, a + 1 + k)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(grad))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (w[b] - w[a] + ridge)
    return step


def fit_additive(x: np.ndarray, y: np.ndarray, bins: int = 32, pair_bins: int = 8, rounds: int = 120, pair_rounds: int = 40,
                 n_pairs: int = 8, rate: float = 0.15, ridge: float = 2.0) -> AdditiveModel:
    """Cyclic boosting: each round passes over the features in turn and adds one shallow tree to the feature's table.

    Then the pairs whose residuals a coarse two-way table explains best get
    tables of their own, boosted in turn likewise. Rows weigh the same. With no
    rows, or rows of one kind, the model is a smoothed constant.
    """
    rows, d = x.shape
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if rows else np.zeros(0) for k in range(d)]
    mean = (y.sum() + 1) / (rows + 2)
    model = AdditiveModel(cuts, float(np.log(mean / (1 - mean))), [np.zeros(len(c) + 1) for c in cuts])
    if not rows or y.min() == y.max():
        return model
    at = model.bins(x)
    f = model.logit(at)
    for _ in range(rounds):
        for k in range(d):
            p = 1 / (1 + np.exp(-f))
            size = len(cuts[k]) + 1
            step = rate * _tree(np.bincount(at[:, k], y - p, size), np.bincount(at[:, k], p * (1 - p), size), 3, ridge)
            model.tables[k] += step
            f += step[at[:, k]]
    p = 1 / (1 + np.exp(-f))
    coarse = [at[:, k] * pair_bins // (len(cuts[k]) + 1) for k in range(d)]

    def two_way(a: int, b: int, p: np.ndarray) -> np.ndarray:
        cell = coarse[a] * pair_bins + coarse[b]
        g, w = (np.bincount(cell, v, pair_bins**2) for v in (y - p, p * (1 - p)))
        return g, w

    gains = {}
    for a, b in itertools.combinations(range(d), 2):
        g, w = two_way(a, b, p)
        gains[a, b] = (g**2 / (w + ridge)).sum()
    chosen = sorted(gains, key=lambda k: (-gains[k], k))[:n_pairs]
    small = {k: np.zeros(pair_bins**2) for k in chosen}
    for _ in range(pair_rounds):
        for a, b in chosen:
            p = 1 / (1 + np.exp(-f))
            g, w = (v.reshape(pair_bins, pair_bins) for v in two_way(a, b, p))
            step = np.zeros((pair_bins, pair_bins))
            half = _best_halves(g, w, ridge)
            for r, c in half:
                step[r, c] = g[r, c].sum() / (w[r, c].sum() + ridge)
            step *= rate
            small[a, b] += step.ravel()
            f += step.ravel()[coarse[a] * pair_bins + coarse[b]]
    for a, b in chosen:
        rows_of = np.arange(len(cuts[a]) + 1) * pair_bins // (len(cuts[a]) + 1)
        cols_of = np.arange(len(cuts[b]) + 1) * pair_bins // (len(cuts[b]) + 1)
        model.pairs[a, b] = small[a, b].reshape(pair_bins, pair_bins)[rows_of][:, cols_of]
    return model


def _best_halves(g: np.ndarray, w: np.ndarray, ridge: float) -> list[tuple[slice, slice]]:
    """The quarter cut of a two-way table that explains most: a tree of depth two, one cut along each feature."""
    n = len(g)
    best, out = -1.0, []
    for r, c in itertools.product(range(1, n), repeat=2):
        parts = [(i, j) for i in (slice(0, r), slice(r, n)) for j in (slice(0, c), slice(c, n))]
        gain = sum(g[i, j].sum() ** 2 / (w[i, j].sum() + ridge) for i, j in parts)
        if gain > best:
            best, out = gain, parts
    return out


def fold(id_col: str, parts: int) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts, F.lit(-1))


def sample_of(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, those of least hash; ids with several labels take the least."""
    return (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(label_col).cast("int")).alias("label"))
            .orderBy(F.xxhash64("id"), "id").limit(rows))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, offsets, data in chunks(batch.column("text")):
            x = text_features(offsets, data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(first, len(x)), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                sample_rows: int = SAMPLE_ROWS) -> AdditiveModel:
    """Fit on at most ``sample_rows`` labelled documents, chosen by the hash of their ids.

    The driver receives one row of numbers for each, never a text.
    """
    chosen = sample_of(labels, id_col, label_col, sample_rows)
    found = (docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
             .join(F.broadcast(chosen), "id").select("label", "text").mapInArrow(_features, "label int, x array<double>").toArrow())
    x = np.array(found["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = found["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return fit_additive(x[order], y[order])


def score_quality(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and score of every document: table lookups and additions over whole batches.

    Null and empty texts get the score of an empty text; repeated rows repeat;
    an empty table gives an empty result. Only the two columns named are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in chunks(batch.column(1)):
                score = model.score(text_features(offsets, data))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(score)), pa.array(score)], [id_col, "score"])

    slim = docs.select(F.col(id_col).cast("long").alias(id_col), text_of(text_col).alias("__text"))
    return slim.mapInArrow(run, f"`{id_col}` long, score double")


def keep_scored(docs: DataFrame, model: AdditiveModel, least: float, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least ``least``, with all their columns; nothing is shuffled."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text_features(offsets, data)) for _, offsets, data in chunks(batch.column(place))]
            yield batch.filter(pa.array(np.concatenate([*scores, np.zeros(0)]) >= least))

    return docs.mapInArrow(run, docs.schema)


#: A document is good from this score on.
GOOD = 0.7


def quality_model(docs: DataFrame, labels: DataFrame) -> AdditiveModel:
    """Learned from labels outside of the held-out quarter of ids."""
    return fit_quality(docs, labels.filter(fold("doc_id", 4) != 2))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of every document."""
    model = quality_model(docs, labels)
    return (score_quality(docs, model)
            .select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")))


def op7_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
