"""What the corpus operators share: tables, word hashing over Arrow buffers, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.session import durable

GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BYTE_CODES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: For terms and tokens of words alone: what is not a letter, digit, underscore or part of a multi-byte character.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str, lower: bool = False) -> Column:
    """The text, empty where it is null."""
    text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.lower(text) if lower else text


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown as texts ask for them."""

    def __init__(self) -> None:
        self.base = 0xD6E8FEB86659FD93
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 21)
            for name, b in (("up", self.base), ("down", pow(self.base, -1, 2**64))):
                steps = np.full(size, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


POWERS = _Powers()


class _Residues:
    """Powers of a base modulo a prime below 2**32 and of its inverse, grown as texts ask for them."""

    def __init__(self, prime: int, base: int) -> None:
        self.prime, self.base = prime, base
        self.up = self.down = np.ones(1, np.uint32)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 21)
            for name, b in (("up", self.base), ("down", pow(self.base, -1, self.prime))):
                powers = np.ones(1, np.uint32)
                while len(powers) < size:
                    step = np.uint64(pow(b, len(powers), self.prime))
                    powers = np.append(powers, (powers[:size - len(powers)] * step % np.uint64(self.prime)).astype(np.uint32))
                setattr(self, name, powers)
        return self.up[:n], self.down[:n]


#: The largest primes below 2**32, with primitive roots of them.
RESIDUES = [(p, _Residues(p, b)) for p, b in ((4294967291, 2246822519), (4294967279, 2654435761))]
#: What keeps the first 0 to 8 bytes of eight.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Bytes of a span whose sum stays below 2**64.
EXACT = 1 << 24


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = 2 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Parts of a text column of about ``limit`` bytes: first row, row offsets in the part, bytes.

    A text is never divided; nulls count as empty.
    """
    arrays = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for array in arrays:
        array = pc.fill_null(array, b"" if pa.types.is_binary(array.type) else "").cast(
            pa.large_binary() if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else pa.large_string())
        if not len(array):
            continue
        _, offsets, data = array.buffers()
        offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and offsets[-1] else np.zeros(0, np.uint8)
        at = 0
        while at < len(array):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            to = min(to, len(array))
            yield row + at, offsets[at:to + 1] - offsets[at], data[offsets[at]:offsets[to]]
            at = to
        row += len(array)


def spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts laid end to end; no word crosses from one text to the next."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~gap[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, word[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, word[1:]
    starts = np.flatnonzero(word & (~before | edge[:n]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes wherever they stand.

    A polynomial in the bytes modulo two primes. Prefix sums may wrap modulo
    2**64: a byte adds less than 2**40, so that the difference over ``EXACT``
    bytes is the sum itself; longer spans are added up in parts.
    """
    code = data.astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(data) + 1, np.uint64)
    out = np.zeros(len(starts), np.uint64)
    for prime, powers in RESIDUES:
        p = np.uint64(prime)
        up, down = powers.get(len(data) + 1)
        np.cumsum(code * up[:len(data)], out=total[1:])
        own = (total[ends] - total[starts]) % p
        for k in np.flatnonzero(ends - starts > EXACT).tolist():
            cut = np.append(np.arange(starts[k], ends[k], EXACT), ends[k])
            own[k] = ((total[cut[1:]] - total[cut[:-1]]) % p).sum() % p
        out = (out << np.uint64(32)) | (own * down[starts] % p)
    return mix(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, short: int = 32) -> np.ndarray:
    """A 64-bit hash of each span of bytes, equal for equal bytes, for spans of which most are short.

    Eight bytes at a time are mixed into what came before, beginning with the
    size, itself mixed; spans of over ``short`` bytes take ``span_hashes``.
    """
    size = ends - starts
    eights = np.append(data, np.zeros(16 - len(data) % 8, np.uint8)).view(np.uint64)
    out = mix(size.astype(np.uint64) + np.uint64(1))
    for k in range(0, short, 8):
        which = np.flatnonzero(size > k) if k else slice(None)
        at, left = starts[which] + k, np.minimum(size[which] - k, 8)
        place, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        value = (eights[place] >> shift) | (eights[place + 1] << (np.uint64(64) - shift))
        value &= _KEEP[left]
        out[which] = mix(out[which] ^ value)
    far = np.flatnonzero(size > short)
    if len(far):
        upto = np.cumsum(size[far])
        body = data[np.repeat(starts[far] - upto + size[far], size[far]) + np.arange(upto[-1])]
        out[far] = span_hashes(body, upto - size[far], upto)
    return out


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different values, a place of each, and which of them each value is."""
    order = np.argsort(values)
    held = values[order]
    new = np.ones(len(values), bool)
    np.not_equal(held[1:], held[:-1], out=new[1:])
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    return held[new], order[new], which


def row_counts(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words in each row."""
    return np.diff(np.searchsorted(starts, offsets))


def gram_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words in each row, and how many each row has.

    A row of fewer words, but some, has one run: all of them.
    """
    total, power = len(words), POWERS.get(n + 1)[0]
    acc = np.zeros(total, np.uint64)
    for k in range(min(n, total)):
        acc[:total - k] += words[k:] * power[k + 1]
    first = np.cumsum(counts) - counts
    have = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    begin = np.cumsum(have) - have
    out = acc[np.repeat(first - begin, have) + np.arange(have.sum())]
    for row in np.flatnonzero((counts > 0) & (counts < n)):
        out[begin[row]] = (words[first[row]:first[row] + counts[row]] * power[1:counts[row] + 1]).sum()
    return mix(out), have


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow list column from values laid end to end."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): columns id and component, the smallest id reachable.

    Alternating large-star and small-star rounds: every round is a minimum per
    node, combined before the shuffle and written, and a join with one row per
    node. Both sides of that join are plain shuffles, so adaptive execution
    splits a node with very many neighbours. The driver sees two numbers a round.
    """
    now = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), "edges")
    stamp = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if stamp == tuple(new) or not new[0]:
            break
        stamp = tuple(new)
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        low = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        least = durable(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = durable(small.union(least.select("a", "m")).distinct(), "edges")
    return (now.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .union(now.select("b", "b")).distinct())


def tie_up(ids: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int, int]]:
    """From linked pairs of one group: id, members linked with it, and the smallest id it reaches, for all that have links."""
    links = np.bincount(i, size[j], len(ids)) + np.bincount(j, size[i], len(ids))
    root = ids.copy()
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == root).all():
            break
        root = new
    return [x for x in zip(ids.tolist(), links.astype(np.int64).tolist(), root.tolist(), strict=True) if x[1]]


def link_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["id", "links", "root"])


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys out of a sorted stream, each as one table."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        if not part.num_rows:
            continue
        change = np.zeros(part.num_rows, bool)
        for key in keys:
            values = part[key].to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(change), part.num_rows]
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            if at == to:
                continue
            now = tuple(part[key][at].as_py() for key in keys)
            if held and now != last:
                yield pa.concat_tables(held)
                held = []
            last = now
            held.append(part.slice(at, to - at))
    if held:
        yield pa.concat_tables(held)
