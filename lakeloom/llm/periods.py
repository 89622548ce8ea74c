"""Periodic runs of words, found by recompression, and texts without their repetitions."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import table, text_of
from lakeloom.llm.grammar import cubic_runs

#: Words of texts whose grammar is held at once; a longer text is held alone.
HELD_WORDS = 1 << 17

_SHAPE = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def text_runs(texts: list[list[bytes]], least: int, repeats: int) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs (start, length, period) of each list of words, and its words without those in a run after its first period."""
    names: dict[bytes, int] = {}
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + 1) - size  # behind a fence each
    total = int((size + 1).sum()) + 1
    sequence = np.empty(total, np.int64)
    owner = np.repeat(np.arange(len(texts) + 1), np.append(size + 1, 1))
    sequence[begin - 1] = -1 - np.arange(len(texts))
    sequence[-1] = -1 - len(texts)
    for at, words in zip(begin.tolist(), texts, strict=True):
        sequence[at:at + len(words)] = [names.setdefault(w, len(names)) for w in words]
    runs = cubic_runs(sequence, owner, int(size.max(initial=0)), least, repeats)
    gone = np.zeros(total + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 1], -1)
    gone = np.cumsum(gone) > 0
    cuts = np.searchsorted(runs[:, 0], np.append(begin, total))
    found, kept = [], []
    for k, words in enumerate(texts):
        own = runs[cuts[k]:cuts[k + 1]]
        found.append(np.stack([own[:, 0] - begin[k], own[:, 1] - own[:, 0], own[:, 2]], 1))
        if len(own):
            words = [words[i] for i in np.flatnonzero(~gone[begin[k]:begin[k] + size[k]]).tolist()]
        kept.append(b" ".join(words))
    return found, kept


def _run_batches(least: int, repeats: int):
    def flush(ids, texts) -> pa.RecordBatch:
        runs, kept = text_runs(texts, least, repeats)
        rows = [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in runs]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(rows, _RUNS),
                                           pa.array(kept, pa.binary())], ["id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held = [], [], 0
            for own, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = bytes(memoryview(body.as_buffer())).split()  # at ASCII white space
                ids.append(own)
                texts.append(words)
                held += len(words)
                if held >= HELD_WORDS:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield flush(ids, texts)
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, repeats: int = 3) -> DataFrame:
    """Stretches of words that repeat with a period.

    A run is a maximal stretch of words with smallest period q, of at least
    ``least`` words and ``repeats`` * q (three or more). Words are runs of
    other bytes than ASCII white space. Returns one row per input row: the id,
    ``n_words``, ``runs`` (start, length, period; by start, then period) and
    ``collapsed``: the words but those that stand in any run after its first
    period, joined by one space, as UTF-8 bytes.

    A text is judged on its own, so nothing is shuffled. Texts of some 100,000
    words together get one run-length grammar by recompression, which answers
    the exact extensions of all places of the harmonic grid whose words agree
    (``grammar.cubic_runs``). Words are compared as bytes, never by a hash. A
    longer text is held alone, with about 100 bytes of memory for a word.

    Defined results: null and empty texts have no words and an empty collapsed
    text; repeated rows give equal rows; rows without an id stay; an empty
    table gives an empty result. Only the two columns named are read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return slim.mapInArrow(_run_batches(least, repeats), _SHAPE).withColumnRenamed("id", id_col)


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            h = zlib.crc32(str(own).encode())
            if own is not None and h % 10 == 0 and (words := body.split()):
                n, g = len(words), h // 10
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                body = b" ".join(words[:a] + (words[a:a + p] * (1 + (n - a) // p))[:n - a])
            texts.append(body)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])


def plant_periods(docs: DataFrame) -> DataFrame:
    """The ids and texts (as UTF-8 bytes) of documents with the periods that op12 plants.

    With h = crc32 of the decimal id and g = h // 10: where h % 10 = 0 and there
    are n > 0 words, word i >= a is word a + (i - a) % p, with a = g % n and
    p = 1 + (n - a) // (3 + g % 8). Texts without an id, and all others, are
    unchanged; null texts are empty.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text"))
    return slim.mapInArrow(_planted, "doc_id long, text binary")


_DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for runs, kept in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            runs = [(r["start"], r["length"], r["period"]) for r in runs]
            best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
            told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
            rows.append((len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
        columns = [pa.array([r[k] for r in rows], pa.int64() if k < 5 else pa.string()) for k in range(7)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns],
                                         ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents after planting: their number, the one with the greatest exponent, and digests."""
    return find_runs(plant_periods(table(spark, sf_dir, "documents"))).select("doc_id", "runs", "collapsed").mapInArrow(_digest, _DIGEST)
