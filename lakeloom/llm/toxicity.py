"""Toxicity from the nearest labelled examples by TF-IDF cosine, found with block-max inverted indexes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import NOT_WORD, chunks, row_counts, span_hashes, spans, table, text_of
from lakeloom.llm.gam import fold, sample_of

#: Labelled rows that examples are taken from at most, terms of the vocabulary at most, examples in a block of the index.
SAMPLE_ROWS, TERMS, BLOCK = 20_000, 512, 64
#: A term belongs to the vocabulary if its chi-square against the label is at least this (p below one in a million).
CHI_SQUARE = 24.0
ROWS = 2048


def _words(offsets: np.ndarray, data: np.ndarray):
    starts, ends = spans(data, offsets, NOT_WORD)
    rows = np.repeat(np.arange(len(offsets) - 1), row_counts(starts, offsets))
    return starts, ends, span_hashes(data, starts, ends), rows


def _first_of_each(rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first of each (row, code), and how many there are."""
    order = np.lexsort((codes, rows))
    new = np.ones(len(order), bool)
    new[1:] = (codes[order][1:] != codes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a term, summed per part before they are shuffled."""
    for batch in batches:
        labels = batch.column("label").to_numpy()
        for first, offsets, data in chunks(batch.column("text")):
            starts, ends, codes, rows = _words(offsets, data)
            one, _ = _first_of_each(rows, codes)
            toxic = labels[first + rows[one]] > 0
            seen, place, inverse = np.unique(codes[one], return_index=True, return_inverse=True)
            text = memoryview(data)
            where = one[place]
            yield pa.RecordBatch.from_arrays([
                pa.array(seen.view(np.int64)),
                pa.array([str(text[a:b], "utf-8") for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)], pa.string()),
                pa.array(np.bincount(inverse.ravel(), toxic, len(seen)).astype(np.int64)), pa.array(np.bincount(inverse.ravel(), minlength=len(seen)))],
                ["code", "term", "toxic", "docs"])


class Vocabulary:
    """Codes of the chosen terms, sorted."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(codes >> np.uint64(46)).astype(np.int64)] = True

    def counts(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and frequency of the vocabulary's terms in the texts."""
        _, _, codes, rows = _words(offsets, data)
        at = np.flatnonzero(self.maybe[(codes >> np.uint64(46)).astype(np.int64)])
        term = np.searchsorted(self.codes, codes[at])
        good = np.append(self.codes, np.uint64(0))[term] == codes[at]
        pair, many = np.unique(rows[at[good]] * np.int64(len(self.codes) + 1) + term[good], return_counts=True)
        return pair // (len(self.codes) + 1), pair % (len(self.codes) + 1), many


def weighed(rows: np.ndarray, terms: np.ndarray, many: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """TF-IDF vectors of length one; zero where no term of the vocabulary stands."""
    x = np.zeros((n, len(idf)), np.float32)
    x[rows, terms] = (1 + np.log(many)) * idf[terms]
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1, keepdims=True))
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


@dataclass
class Examples:
    """Different example vectors in blocks; each has a count, how many are toxic, and an id to show as evidence."""

    vectors: np.ndarray
    count: np.ndarray
    toxic: np.ndarray
    shown: np.ndarray
    none: tuple[float, float]  # count and toxic of examples without any term
    k: int = 16
    slope: float = 1.0
    shift: float = 0.0

    def __post_init__(self) -> None:
        n, v = self.vectors.shape
        self.blocks = -(-n // BLOCK)
        full = np.zeros((self.blocks * BLOCK, v), np.float32)
        full[:n] = self.vectors
        self.by_block = full.reshape(self.blocks, BLOCK, v)
        self.most = self.by_block.max(1).T.copy() if n else np.zeros((v, 0), np.float32)

    def nearest(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine for each query: similarities and example numbers.

        The greatest weight of each term in a block bounds the cosine of all
        its examples. Blocks are visited by falling bound until the bound does
        not beat the k-th similarity found.
        """
        n, k = len(q), self.k
        best = np.zeros((n, k), np.float32)
        who = np.full((n, k), -1, np.int64)
        if not self.blocks or not n:
            return best, who
        bound = q @ self.most + np.float32(1e-6)
        order = np.argsort(-bound, axis=1, kind="stable")
        live = np.flatnonzero(bound.max(1) > 2e-6)
        for step in range(self.blocks):
            block = order[live, step]
            go = bound[live, block] > best[live, -1] + np.float32(1e-6)
            live, block = live[go], block[go]
            if not len(live):
                break
            by = np.argsort(block, kind="stable")
            cut = np.flatnonzero(np.append(True, block[by][1:] != block[by][:-1]))
            for a, b in zip(cut, np.append(cut[1:], len(by)), strict=True):
                own = live[by[a:b]]
                at = int(block[by[a]])
                found = q[own] @ self.by_block[at].T
                sims = np.concatenate([best[own], found], 1)
                names = np.concatenate([who[own], np.broadcast_to(np.arange(at * BLOCK, (at + 1) * BLOCK), found.shape)], 1)
                top = np.lexsort((names, -sims), axis=1)[:, :k]
                best[own], who[own] = np.take_along_axis(sims, top, 1), np.take_along_axis(names, top, 1)
        who[best <= 0] = -1
        return best, who

    def votes(self, sims: np.ndarray, who: np.ndarray, without: np.ndarray | None = None) -> np.ndarray:
        """Share of toxic among the neighbours, each counted by nearness; those without neighbours like examples without terms."""
        near = (who >= 0) / (1.05 - np.minimum(sims, 1.0))
        count, toxic = self.count[who] * near, self.toxic[who] * near
        if without is not None:  # leave the example itself out
            own = who == np.arange(len(who))[:, None]
            count, toxic = count - own * near, toxic - own * near * without[:, None]
        base = self.base
        share = (toxic.sum(1) + base) / (count.sum(1) + 1)
        alone = (self.none[1] + base) / (self.none[0] + 1)
        return np.where((who >= 0).any(1), share, alone)

    @property
    def base(self) -> float:
        return (self.toxic.sum() + self.none[1] + 0.5) / (self.count.sum() + self.none[0] + 1)

    def scores(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sims, who = self.nearest(q)
        p = np.clip(self.votes(sims, who), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(p / (1 - p)) + self.shift))), sims, who

    def calibrate(self, rows: int = 4000) -> None:
        """A logistic curve from votes to frequencies, fitted on examples that are left out of their own vote."""
        n = min(rows, len(self.vectors))
        if not n:
            return
        sims, who = self.nearest(self.vectors[:n])
        rate = self.toxic[:n] / self.count[:n]
        p = np.clip(self.votes(sims, who, rate), 1e-6, 1 - 1e-6)
        p = np.append(p, np.clip((self.none[1] + self.base) / (self.none[0] + 1), 1e-6, 1 - 1e-6))
        x = np.log(p / (1 - p))
        total, hits = np.append(self.count[:n], self.none[0]), np.append(self.toxic[:n], self.none[1])
        a, b = 1.0, 0.0
        for _ in range(25):
            f = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g, w = hits - total * f, total * f * (1 - f) + 1e-9
            grad = np.array([(g * x).sum() - (a - 1), g.sum() - b])
            hess = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
            step = np.clip(np.linalg.solve(hess, grad), -1, 1)
            a, b = a + step[0], b + step[1]
        if a > 0:
            self.slope, self.shift = float(a), float(b)


def fit_examples(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 sample_rows: int = SAMPLE_ROWS, terms: int = TERMS) -> tuple[np.ndarray, np.ndarray, Examples]:
    """Codes and weights of the vocabulary, and the indexed examples.

    Examples are at most ``sample_rows`` labelled rows, chosen by the hash of
    their ids. The vocabulary is the terms, at most ``terms``, whose presence
    depends most on the label among them. Inverse document frequencies of these
    count all documents. The driver receives term counts and example vectors,
    both bounded by these parameters.
    """
    chosen = F.broadcast(sample_of(labels, id_col, label_col, sample_rows))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col, lower=True).alias("text"))
    labelled = slim.join(chosen, "id").select("id", "label", "text")
    sizes = labelled.agg(F.count("*"), F.sum((F.col("label") > 0).cast("int"))).first()
    n, toxic = float(sizes[0]), float(sizes[1] or 0)
    counts = (labelled.mapInArrow(_term_counts, "code long, term string, toxic long, docs long").groupBy("code")
              .agg(F.sum("toxic").cast("double").alias("a"), F.sum("docs").cast("double").alias("d")))
    cross = F.lit(n) * F.pow(F.col("a") * F.lit(n) - F.lit(toxic) * F.col("d"), F.lit(2.0))
    whole = F.col("d") * (F.lit(n) - F.col("d")) * F.lit(toxic) * F.lit(n - toxic)
    best = (counts.filter("d >= 2").withColumn("chi", F.when(whole > 0, cross / whole).otherwise(0)).filter(F.col("chi") >= CHI_SQUARE)
            .orderBy(F.desc("chi"), "code").limit(terms).select("code").toArrow())
    codes = np.sort(best["code"].to_numpy().astype(np.int64).view(np.uint64))
    words = Vocabulary(codes)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(codes) + 1, np.int64)
        for batch in batches:
            for _, offsets, data in chunks(batch.column(0)):
                total[:-1] += np.bincount(words.counts(offsets, data)[1], minlength=len(codes))
                total[-1] += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(codes) + 1)), pa.array(total)], ["term", "docs"])

    found = slim.select("text").mapInArrow(documents, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()
    df = np.zeros(len(codes) + 1)
    df[found["term"].to_numpy()] = found["docs"].to_numpy()
    idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in chunks(batch.column("text")):
                row, term, many = words.counts(offsets, data)
                size = len(offsets) - 1
                at = np.searchsorted(row, np.arange(size + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(first, size), batch.column("label").slice(first, size),
                    pa.array([np.stack([term[a:b], many[a:b]], 1).ravel() for a, b in zip(at[:-1], at[1:], strict=True)], pa.list_(pa.int64()))],
                    ["id", "label", "terms"])

    groups: dict[tuple, list] = {}
    for row in zip(*(c.to_pylist() for c in labelled.mapInArrow(vectors, "id long, label int, terms array<long>").toArrow().columns), strict=True):
        held = groups.setdefault(tuple(row[2]), [0, 0, row[0]])
        held[0] += 1
        held[1] += row[1] > 0
        held[2] = min(held[2], row[0])
    none = groups.pop((), [0, 0, 0])
    keys = sorted(groups, key=lambda t: (-max(zip(idf[list(t[::2])], t[::2], strict=True))[0], t))  # alike ones side by side
    rows = np.repeat(np.arange(len(keys)), [len(k) // 2 for k in keys]) if keys else np.zeros(0, np.int64)
    flat = np.array([x for k in keys for x in k], np.int64)
    x = weighed(rows, flat[::2], flat[1::2], len(keys), idf)
    held = np.array([groups[k] for k in keys], np.int64).reshape(-1, 3)
    examples = Examples(x, np.append(held[:, 0], 0), np.append(held[:, 1], 0), np.append(held[:, 2], -1), (none[0], none[1]))
    examples.calibrate()
    return codes, idf, examples


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   evidence: int = 3, **bounds: int) -> DataFrame:
    """Id, ``score`` (calibrated share of toxic among the nearest examples) and ``evidence`` of every document.

    Evidence is up to ``evidence`` structs of an example's id, its cosine and
    the toxic share of examples with that vector. The index that tasks hold is
    bounded by ``sample_rows`` and ``terms``.

    Defined results: terms are runs of letters, digits, underscores and
    characters beyond ASCII, in lower case. Null and empty texts, and texts
    without any term of the vocabulary, get the share of labelled examples
    without such terms. Equal examples count together, so ties cannot crowd
    each other out; other ties go to the example that stands first. Repeated
    rows repeat. Without labels every score is one half; an empty table gives an
    empty result. Only the columns named are read.
    """
    codes, idf, examples = fit_examples(docs, labels, id_col, text_col, label_col, **bounds)
    sent = docs.sparkSession.sparkContext.broadcast((codes, idf, examples.vectors, examples.count, examples.toxic, examples.shown, examples.none,
                                                     examples.k, examples.slope, examples.shift))
    made: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.extend([Vocabulary(sent.value[0]), sent.value[1], Examples(*sent.value[2:])])
        words, idf, index = made
        share = index.toxic / np.maximum(index.count, 1)
        for batch in batches:
            for first, offsets, data in chunks(batch.column(1)):
                row, term, many = words.counts(offsets, data)
                for a in range(0, len(offsets) - 1, ROWS):
                    b = min(a + ROWS, len(offsets) - 1)
                    own = slice(*np.searchsorted(row, [a, b]))
                    scores, sims, who = index.scores(weighed(row[own] - a, term[own], many[own], b - a, idf))
                    shown = [[{"id": int(index.shown[w]), "cosine": float(s), "toxic": float(share[w])} for s, w in zip(x[:evidence], y[:evidence], strict=True) if w >= 0]
                             for x, y in zip(sims, who, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first + a, b - a), pa.array(scores),
                         pa.array(shown, pa.list_(pa.struct([("id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())])))],
                        ["id", "score", "evidence"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col, lower=True).alias("text"))
    return (slim.mapInArrow(run, "id long, score double, evidence array<struct<id:long,cosine:double,toxic:double>>")
            .withColumnRenamed("id", id_col))


def op4_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return (score_toxicity(docs, labels.filter(fold("doc_id", 5) != 0))
            .select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence"))
