"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import NOT_WORD, chunks, durable, gram_hashes, row_counts, span_hashes, spans, table, text_of

#: Benchmark words in one round over the documents; what a task holds of the benchmark is bounded by it.
ROUND_WORDS = 2_000_000
_BASE, _MOD = 0x9E3779B1, (1 << 61) - 1


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = spans(data, offsets, NOT_WORD)
    return span_hashes(data, starts, ends), row_counts(starts, offsets)


def _rolling(words: list[int], free: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """Karp-Rabin values of all runs of ``length`` free words, with their places."""
    top = pow(_BASE, length, _MOD)
    value = run = 0
    for k, word in enumerate(words):
        if not free[k]:
            value = run = 0
            continue
        value = (value * _BASE + word) % _MOD
        run += 1
        if run > length:
            value = (value - words[k - length] * top) % _MOD
        if run >= length:
            yield value, k - length + 1


def greedy_tiles(item: list[int], doc: list[int], shortest: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in doc, words): the longest common runs of words not yet part of a tile, again and again.

    The search length starts at the item's length and halves while nothing that
    long is found; matches found are extended and, if a longer one than the
    search length turns up, the search is repeated at that length. At the
    shortest length it is repeated until it adds no tile.
    """
    free_i, free_d = [True] * len(item), [True] * len(doc)
    tiles = []
    search = max(min(len(item), len(doc)), shortest)
    while True:
        table = defaultdict(list)
        for value, at in _rolling(doc, free_d, search):
            table[value].append(at)
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        longest = 0
        for value, i in _rolling(item, free_i, search):
            for d in table.get(value, ()):
                k = 0
                while i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k] and free_i[i + k] and free_d[d + k]:
                    k += 1
                if k >= search:
                    found[k].append((i, d))
                    longest = max(longest, k)
        if longest > 2 * search:
            search = longest
            continue
        before = len(tiles)
        for k in sorted(found, reverse=True):
            for i, d in found[k]:
                if all(free_i[i:i + k]) and all(free_d[d:d + k]):
                    tiles.append((i, d, k))
                    free_i[i:i + k] = [False] * k
                    free_d[d:d + k] = [False] * k
        if search <= shortest:
            if len(tiles) == before:
                return tiles
            continue  # matches that clashed with a tile may have a free rest that is long enough
        search = max(shortest, search // 2)


class _Items:
    """One round's benchmark items: words of each, and which items hold a seed."""

    def __init__(self, rows: list[tuple[int, bytes]], shortest: int) -> None:
        self.words = {i: np.frombuffer(raw, np.uint64) for i, raw in rows}
        seeds, owners = [], []
        for i, words in self.words.items():
            grams, _ = gram_hashes(words, np.array([len(words)]), min(shortest, len(words)))
            seeds.append(grams)
            owners += [i] * len(grams)
        order = np.argsort(np.concatenate(seeds), kind="stable") if seeds else np.zeros(0, np.int64)
        self.seeds = np.concatenate(seeds)[order] if seeds else np.zeros(0, np.uint64)
        self.owners = np.array(owners, np.int64)[order]
        self.maybe = np.zeros(1 << 24, bool)
        self.maybe[(self.seeds >> np.uint64(40)).astype(np.int64)] = True


def _tile(spark: SparkSession, rows: list[tuple[int, bytes]], shortest: int):
    sent = spark.sparkContext.broadcast((rows, shortest))
    made: list[_Items] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, shortest = sent.value
        if not made:
            made.append(_Items(rows, shortest))
        items = made[0]
        short = sorted({len(w) for w in items.words.values() if len(w) < shortest})
        for batch in batches:
            out = []
            for first, offsets, data in chunks(batch.column(1)):
                words, counts = word_codes(data, offsets)
                begin = np.cumsum(counts) - counts
                pairs = set()
                for n in [*short, shortest]:
                    grams, have = gram_hashes(words, counts, n)
                    at = np.flatnonzero(items.maybe[(grams >> np.uint64(40)).astype(np.int64)])
                    lo, hi = (np.searchsorted(items.seeds, grams[at], side) for side in ("left", "right"))
                    row = np.searchsorted(np.cumsum(have), at, "right")
                    for r, a, b in zip(row[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                        pairs.update((r, i) for i in items.owners[a:b].tolist())
                for r, i in sorted(pairs):
                    item, doc = items.words[i], words[begin[r]:begin[r] + counts[r]]
                    near = np.isin(doc, item)  # words of other kinds only part the text
                    tiles = greedy_tiles(item.tolist(), _parted(doc, near, item), min(shortest, len(item)))
                    if tiles:
                        out.append((first + r, i, len(tiles), sum(t[2] for t in tiles), max(t[2] for t in tiles), len(item)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array([x[0] for x in out], pa.int64())),
                *(pa.array([x[k] for x in out], pa.int64()) for k in range(1, 6)),
            ], ["id", "item", "tiles", "covered", "longest", "words"])
    return run


def _parted(doc: np.ndarray, near: np.ndarray, item: np.ndarray) -> list[int]:
    """The words that the item has too; each gap between them becomes one word that it has not."""
    keep = near.copy()
    keep[1:] |= near[:-1]
    out = np.where(near, doc, np.uint64(0))[keep]
    return out.tolist()


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", shortest: int = 5, coverage: float = 0.6) -> DataFrame:
    """Pairs of a document and a benchmark item whose text it covers to ``coverage`` or more, in any order of passages.

    Columns: the two ids, ``tiles``, ``covered`` (words of the item in tiles),
    ``longest`` (words of the longest tile), ``item_words``, ``coverage``.

    Words are runs of letters, digits, underscores and characters beyond ASCII,
    in lower case. A shared run of ``shortest`` words seeds a pair; the pair is
    then tiled: the longest common runs of words outside of earlier tiles are
    found by running Karp-Rabin values and marked until none of ``shortest``
    words is left. Coverage is the marked share of the item, so an item whose
    sentences stand in another order is found too.

    Documents are never shuffled: the benchmark goes to them in rounds of at
    most ``ROUND_WORDS`` words, however long it is.

    Defined results: an item of fewer than ``shortest`` words needs all of
    them. Items without words, null texts and empty texts match nothing. Rows
    without an id give pairs with a null id. Repeated rows give repeated pairs;
    of benchmark rows with one id the one with the greatest text counts. Empty
    tables give an empty result. Only the columns named are read.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col, lower=True).alias("text"))
    items = (benchmark.filter(F.col(item_id_col).isNotNull())
             .groupBy(F.col(item_id_col).cast("long").alias("id")).agg(F.max(text_of(item_text_col, lower=True)).alias("text")))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in chunks(batch.column(1)):
                codes, counts = word_codes(data, offsets)
                at = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(counts)), pa.array(counts, pa.int64()),
                    pa.array([codes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["id", "n", "codes"])

    made = durable(items.mapInArrow(words, "id long, n long, codes binary").filter("n > 0"), "items")
    total = made.agg(F.sum("n")).first()[0] or 0
    rounds = -(-total // ROUND_WORDS)
    found = None
    for k in range(max(1, rounds)):
        part = made.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, rounds))) == k) if rounds > 1 else made
        rows = [(r.id, bytes(r.codes)) for r in part.select("id", "codes").toLocalIterator()]
        now = slim.mapInArrow(_tile(spark, rows, shortest), "id long, item long, tiles long, covered long, longest long, words long")
        found = now if found is None else found.union(now)
    return (found.withColumn("coverage", F.col("covered") / F.col("words")).filter(F.col("coverage") >= coverage)
            .select(F.col("id").alias(id_col), F.col("item").alias(item_id_col), "tiles", "covered", "longest",
                    F.col("words").alias("item_words"), "coverage"))


def op2_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
