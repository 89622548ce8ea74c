"""Token ids packed into fixed-length sequences by best-fit decreasing."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import SPACE, chunks, distinct, table, text_of, word_hashes
from lakeloom.llm.pieces import gather

VOCABULARY = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")
#: Tokens that are packed together; units whose ids a task remembers.
WINDOW_TOKENS, REMEMBERED = 1 << 20, 1_000_000

# Fixed value: how byte-level BPE vocabularies of this family part a text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Fixed value: what stands before the last byte of any white space beyond ASCII in UTF-8
_MAY_END_SPACE = np.zeros(256, bool)
_MAY_END_SPACE[[0xC2, 0x9A, 0x80, 0x81]] = True


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the pattern always parts a text: around white space, the last space of a run going with the next word."""
    if not len(data):
        return np.zeros(0, np.int64)
    begin = np.zeros(len(data) + 1, bool)
    begin[offsets] = True
    space = SPACE[data]
    cut = begin[:-1].copy()
    cut[1:] |= space[1:] & ~space[:-1]
    cut[:-1] |= space[:-1] & ~space[1:] & ~begin[1:-1]
    cut[1:] |= ~space[1:] & space[:-1] & (data[:-1] != 32)
    return np.flatnonzero(cut)


class UnitIds:
    """Ids of units, remembered by hash; when too many are held, all are forgotten."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        import tiktoken

        self.encoding = tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        self.length[np.fromiter(ranks.values(), np.int64, len(ranks))] = np.fromiter(map(len, ranks), np.int64, len(ranks))
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _spell(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units laid end to end, and how many each has.

        The pattern parts a unit that follows others as it parts it alone, if it
        begins with a space and the one before does not end in white space;
        such units are spelled in one call.
        """
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        joined = (data[starts] == 32) & (ends - starts > 1) & (((last > 32) & (last < 127)) | ((last > 127) & ~_MAY_END_SPACE[before]))
        size = np.zeros(len(starts), np.int64)
        a, b = starts[joined], ends[joined]
        ids = self.encoding.encode_to_numpy(str(gather(data, a, b - a), "utf-8")).astype(np.int32)
        size[joined] = np.diff(np.searchsorted(np.cumsum(self.length[ids]), np.cumsum(b - a)) + 1, prepend=0)
        text, alone = memoryview(data), np.flatnonzero(~joined)
        if not len(alone):
            return ids, size
        others = [self.encoding.encode_ordinary(str(text[a:b], "utf-8")) for a, b in zip(starts[alone].tolist(), ends[alone].tolist(), strict=True)]
        size[alone] = [len(x) for x in others]
        flat, of_joined = np.empty(int(size.sum()), np.int32), np.repeat(joined, size)
        flat[of_joined] = ids
        flat[~of_joined] = [i for x in others for i in x]
        return flat, size

    def units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the different units, the unit of each span, and the place of each unit's ids in ``start`` and ``size``."""
        hashes, one, unit = distinct(word_hashes(data, starts, ends))
        at = np.searchsorted(self.keys, hashes)
        new = np.flatnonzero(np.append(self.keys, np.uint64(0))[at] != hashes)
        if len(new) and len(self.keys) and len(self.keys) + len(new) > REMEMBERED:
            self._forget()
            at, new = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
        if len(new):
            ids, size = self._spell(data, starts[one[new]], ends[one[new]])
            self.start = np.insert(self.start, at[new], len(self.flat) + np.cumsum(size) - size)
            self.size = np.insert(self.size, at[new], size)
            self.flat = np.concatenate([self.flat, ids])
            self.keys = np.insert(self.keys, at[new], hashes[new])
            at = np.searchsorted(self.keys, hashes)
        return hashes, unit, at

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts laid end to end, and how many each has."""
        starts = unit_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        _, unit, at = self.units(data, starts, np.append(starts[1:], len(data)))
        which = at[unit]
        row = np.searchsorted(offsets, starts, "right") - 1
        return gather(self.flat, self.start[which], self.size[which]), np.bincount(row, self.size[which], len(offsets) - 1).astype(np.int64)


class Capacities:
    """Open sequences by room left, in a segment tree that finds the least room which suffices."""

    def __init__(self, most: int) -> None:
        self.width = 1 << most.bit_length()
        self.many = [0] * (2 * self.width)
        self.open: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, room: int, sequence: int) -> None:
        self.open[room].append(sequence)
        at = room + self.width
        while at:
            self.many[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The sequence with the least room of at least ``need``; of equals the one opened last."""
        at = need + self.width
        while not self.many[at]:
            while at & 1:  # a right child: go up until there is a right sibling
                at >>= 1
            if not at:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the right edge
                return None
        while at < self.width:
            at = 2 * at if self.many[2 * at] else 2 * at + 1
        room = at - self.width
        sequence = self.open[room].pop()
        while at:
            self.many[at] -= 1
            at >>= 1
        return room, sequence


def pack(sizes: list[int], length: int) -> list[list[int]]:
    """Best-fit decreasing: pieces by size, each into the fullest sequence that still has room."""
    rooms = Capacities(length)
    out: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        found = rooms.take(sizes[k])
        if found is None:
            found = length, len(out)
            out.append([])
        out[found[1]].append(k)
        if found[0] > sizes[k]:
            rooms.add(found[0] - sizes[k], found[1])
    return out


def split(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of at most ``length`` tokens of every document: document, first token in it, tokens."""
    many = -(-sizes // length)
    doc = np.repeat(np.arange(len(sizes)), many)
    first = (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)) * length
    return doc, first, np.minimum(sizes[doc] - first, length)


def _window(parts: list[tuple[pa.Array, np.ndarray, np.ndarray]], length: int, pad: int, shard: int, number: int) -> pa.RecordBatch:
    flat = np.concatenate([p[1] for p in parts])
    sizes = np.concatenate([p[2] for p in parts])
    owner = pa.concat_arrays([p[0] for p in parts]).to_pylist()
    doc, first, size = split(sizes, length)
    at = (np.cumsum(sizes) - sizes)[doc] + first
    ids, starts, positions, docs, froms, tokens = [], [], [], [], [], []
    for pieces in pack(size.tolist(), length):
        cut = np.concatenate([[0], np.cumsum(size[pieces])])
        row = np.full(length, pad, "<u2")
        row[:cut[-1]] = np.concatenate([flat[a:a + n] for a, n in zip(at[pieces].tolist(), size[pieces].tolist(), strict=True)])
        place = np.zeros(length, "<u2")
        place[:cut[-1]] = np.arange(cut[-1]) - np.repeat(cut[:-1], np.diff(cut))
        ids.append(row.tobytes())
        positions.append(place.tobytes())
        starts.append(cut.tolist())
        docs.append([owner[k] for k in doc[pieces].tolist()])
        froms.append(first[pieces].tolist())
        tokens.append(int(cut[-1]))
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [pa.array([shard] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(ids, pa.binary()),
         pa.array(starts, pa.list_(pa.int32())), pa.array(positions, pa.binary()), pa.array(docs, pa.list_(pa.int64())),
         pa.array(froms, pa.list_(pa.int64())), pa.array(tokens, pa.int32())],
        ["shard", "window", "sequence", "ids", "cu_seqlens", "positions", "doc_ids", "doc_starts", "n_tokens"])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def pack_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, length: int = 2048,
                end: int = 50256, pad: int = 50256) -> DataFrame:
    """All documents as token ids in sequences of ``length``: one row per packed sequence.

    ``ids`` is a row of the id matrix (``length`` little-endian 16-bit numbers,
    filled up with ``pad`` after ``n_tokens``), ``cu_seqlens`` the cumulative
    segment lengths from 0 on, ``positions`` a place per token (16 bits each)
    that restarts at 0 with every segment. Segment k is the part of document
    ``doc_ids[k]`` from token ``doc_starts[k]`` on. Each document ends with the
    ``end`` token. A document longer than a sequence is split into full pieces
    and a rest; put together by ``doc_starts`` they are the document again.

    Each task packs its documents in windows of about a million tokens, by
    best-fit decreasing with a segment tree over the room left; nothing is
    shuffled. ``shard``, ``window`` and ``sequence`` name a row. Texts are cut
    at white space, so the ids of a word are computed once per task.

    Defined results: null and empty texts are the ``end`` token alone; repeated
    rows are packed again; null ids stay null; an empty table gives an empty
    result. Only the two columns named are read. The vocabulary is read on the
    driver and is all that is broadcast.
    """
    if length >= 2**16 or max(end, pad) >= 2**16:
        raise ValueError("ids and positions are written in 16 bits")
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    made: list[UnitIds] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(UnitIds(sent.value))
        context = TaskContext.get()
        shard, number = context.partitionId() if context else 0, 0
        parts, held = [], 0
        for batch in batches:
            for first, offsets, data in chunks(batch.column(1), 1 << 20):
                ids, count = made[0].encode(data, offsets)
                full = np.insert(ids, np.cumsum(count), end)
                parts.append((batch.column(0).slice(first, len(count)), full.astype(np.uint16), count + 1))
                held += len(full)
                if held >= WINDOW_TOKENS:
                    yield _window(parts, length, pad, shard, number)
                    parts, held, number = [], 0, number + 1
        if parts:
            yield _window(parts, length, pad, shard, number)

    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return slim.mapInArrow(run, "shard int, window int, sequence int, ids binary, cu_seqlens array<int>, positions binary, "
                                "doc_ids array<long>, doc_starts array<long>, n_tokens int")


def op6_packed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"))
