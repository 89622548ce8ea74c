"""Sampled SentencePiece segmentations by forward filtering and backward sampling, and their decoding."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import BYTE_CODES, GOLD, POWERS, chunks, mix, ragged, span_hashes, table, text_of

MODEL = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")
#: Bytes of text whose lattices are held at once; a lattice takes some hundred bytes for each.
CHUNK = 1 << 20
_MARK = "▁".encode()


@dataclass
class Pieces:
    """A vocabulary: the bytes of each id (the space mark as a space), log weights, and all prefixes by hash."""

    raw: list[bytes]
    weight: np.ndarray
    usable: np.ndarray  # ids that stand for text, without single-byte ids
    byte_id: np.ndarray

    @classmethod
    def load(cls, path: str, smoothing: float = 1.0) -> Pieces:
        """Weights fall with the logarithm of a piece's merge rank."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        raw, usable, byte_id = [], np.zeros(size, bool), np.zeros(256, np.int64)
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_id[int(piece[3:5], 16)] = i
                raw.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                raw.append(b"")
            else:
                raw.append(piece.encode().replace(_MARK, b" "))
                usable[i] = True
        rank = np.array([min(max(-model.get_score(i), 0), size) for i in range(size)])
        return cls(raw, -smoothing * np.log(rank + 2), usable, byte_id)

    def __post_init__(self) -> None:
        size = np.array([len(r) for r in self.raw])
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        self.data = np.frombuffer(b"".join(self.raw), np.uint8)
        ids = np.flatnonzero(self.usable & (size > 0))
        self.longest = int(size[ids].max())
        found: dict[int, int] = {}
        per = size[ids]
        start = np.repeat(self.starts[ids], per)
        length = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + 1
        hashes = _Spans(self.data)(start, length)
        owner = np.where(length == np.repeat(per, per), np.repeat(ids, per), -1)
        for h, i in zip(hashes.tolist(), owner.tolist(), strict=True):
            if i >= 0 or h not in found:
                found[h] = i
        self.keys = np.array(sorted(found), np.uint64)
        self.ids = np.array([found[int(h)] for h in self.keys.tolist()], np.int64)
        slot = (self.keys >> np.uint64(44)).astype(np.int64)
        self.slots = np.searchsorted(slot, np.arange((1 << 20) + 1))
        self.run = int(np.diff(self.slots).max())

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """The id of the piece with this hash; -1 for a mere prefix, -2 for neither."""
        at = self.slots[(h >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(h), -2, np.int64)
        for k in range(self.run):
            here = np.minimum(at + k, len(self.keys) - 1)
            hit = self.keys[here] == h
            out[hit] = self.ids[here[hit]]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of an id sequence; the space that encoding puts first goes."""
        return b"".join([self.raw[i] for i in ids.tolist()])[1:]


def lay_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space put before each that is not empty."""
    size = np.diff(offsets)
    more = (size > 0).astype(np.int64)
    new = np.concatenate([[0], np.cumsum(size + more)])
    out = np.full(new[-1], 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.cumsum(more), size)] = data
    return out, new


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where no piece can cross: before the first space of a run, and around line feeds."""
    cut = np.zeros(len(data), bool)
    if len(data):
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        cut[1:] |= (data[1:] == 32) & (data[:-1] != 32)
        cut[1:] |= (data[1:] == 10) | (data[:-1] == 10)
    return np.flatnonzero(cut)


class Lattice:
    """All segmentations of distinct units: forward sums, then for every place the chances of the pieces that end there."""

    def __init__(self, pieces: Pieces, data: np.ndarray, ends: np.ndarray) -> None:
        size = np.diff(np.concatenate([[0], ends]))
        stop = np.repeat(ends, size)
        first = stop - np.repeat(size, size)
        src, dst, ids = [], [], []
        alive = np.arange(len(data))
        up_hash = _Spans(data)
        for length in range(1, pieces.longest + 1):
            alive = alive[alive + length <= stop[alive]]
            if not len(alive):
                break
            found = pieces.look_up(up_hash(alive, length))
            good = found >= 0
            src.append(alive[good])
            dst.append(alive[good] + length)
            ids.append(found[good])
            alive = alive[found >= -1]
        lead = (data & 0xC0) != 0x80
        char = np.flatnonzero(lead)
        char_end = np.append(char[1:], len(data))
        whole = np.concatenate(src) * 8 + (np.concatenate(dst) - np.concatenate(src)) if src else np.zeros(0, np.int64)
        lone = ~np.isin(char * 8 + (char_end - char), whole[np.concatenate([d - s for s, d in zip(src, dst, strict=True)]) < 8] if src else whole)
        of_char = np.cumsum(lead) - 1
        single = np.flatnonzero(lone[of_char]) if len(data) else np.zeros(0, np.int64)
        src.append(single)
        dst.append(single + 1)
        ids.append(pieces.byte_id[data[single]])
        src, dst, ids = (np.concatenate(x[::-1]) for x in (src, dst, ids))
        # a node is a place after a byte and has that byte's number; the longest pieces that end there come first
        order = np.argsort(dst, kind="stable")
        src, ids, node = src[order], ids[order], dst[order] - 1
        weight = pieces.weight[ids]
        depth = node + 1 - first[node]
        by_depth = np.argsort(depth.astype(np.int16) if depth.max(initial=0) < 2**15 else depth, kind="stable")
        bounds = np.searchsorted(depth[by_depth], np.arange(1, depth.max(initial=0) + 2))
        ahead = np.full(len(data), -np.inf)  # log sum of all ways to a node
        chance = np.empty(len(node))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            e = by_depth[a:b]
            if not len(e):
                continue
            s, n = src[e], node[e]
            way = weight[e] + np.where(s == first[n], 0.0, ahead[np.maximum(s - 1, 0)])
            new = np.flatnonzero(np.append(True, n[1:] != n[:-1]))
            per = np.diff(np.append(new, len(n)))
            high = np.maximum.reduceat(way, new)
            high = np.where(np.isfinite(high), high, 0.0)
            part = np.exp(way - np.repeat(high, per))
            sums = np.add.reduceat(part, new)
            with np.errstate(divide="ignore"):
                ahead[n[new]] = high + np.log(sums)
            chance[e] = part / np.repeat(np.maximum(sums, 1e-300), per)
        new = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        run = np.cumsum(chance)
        self.upto = (run - np.repeat(run[new] - chance[new], np.diff(np.append(new, len(node))))).astype(np.float32)
        self.upto[np.append(new[1:], len(node))[:len(new)] - 1] = 2.0  # the last piece takes what rounding leaves
        self.edges = np.zeros(len(data), np.int32)
        self.edges[node[new]] = new
        self.src, self.ids, self.first, self.ends = src.astype(np.int32), ids.astype(np.int32), first, ends

    def sample(self, unit: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each occurrence of a unit the ids of one segmentation, drawn backwards, and how many they are."""
        live = np.argsort(unit, kind="stable")  # occurrences of one unit side by side read the same memory
        at = self.ends[unit[live]] - 1
        begin, own = self.first[at], seed[live]
        who, drawn = [], []
        while len(live):
            own = mix(own + GOLD)
            e = self.edges[at].astype(np.int64)
            u = ((own >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24))
            wait = np.flatnonzero(u >= self.upto[e])
            while len(wait):
                e[wait] += 1
                wait = wait[u[wait] >= self.upto[e[wait]]]
            who.append(live)
            drawn.append(self.ids[e])
            back = self.src[e]
            more = np.flatnonzero(back > begin)
            live, at, begin, own = live[more], back[more] - 1, begin[more], own[more]
        count = np.zeros(len(unit), np.int64)
        for w in who:
            count[w] += 1
        last = np.cumsum(count) - 1
        out = np.empty(int(count.sum()), np.int32)
        for k, (w, d) in enumerate(zip(who, drawn, strict=True)):
            out[last[w] - k] = d
        return out, count


class _Spans:
    """Hashes of many spans of one buffer, none longer than a piece: below 1,024 bytes no two spans clash by design."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = POWERS.get(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * up[:len(data)], out=self.total[1:])

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return mix((self.total[start + length] - self.total[start]) * self.down[start] + np.atleast_1d(length).astype(np.uint64) * GOLD)


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Spans laid end to end."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return data[np.repeat(shift, sizes) + np.arange(sizes.sum())]


def encode_texts(pieces: Pieces, data: np.ndarray, offsets: np.ndarray, keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts laid end to end, and how many each text has."""
    body, at = lay_out(data, offsets)
    starts = unit_starts(body, at)
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(keys), np.int64)
    ends = np.append(starts[1:], len(body))
    _, one, unit = np.unique(span_hashes(body, starts, ends), return_index=True, return_inverse=True)
    size = (ends - starts)[one]
    lattice = Lattice(pieces, gather(body, starts[one], size), np.cumsum(size))
    row = np.searchsorted(at, starts, "right") - 1
    nth = np.arange(len(starts)) - np.searchsorted(starts, at)[row]
    own = mix(mix(keys.view(np.uint64) + np.uint64(seed * int(GOLD) % 2**64))[row] ^ (nth.astype(np.uint64) * GOLD))
    ids, count = lattice.sample(unit.ravel(), own)
    return ids, np.bincount(row, count, len(keys)).astype(np.int64)


def _encode(spark: SparkSession, pieces: Pieces, seed: int):
    sent = spark.sparkContext.broadcast((pieces.raw, pieces.weight, pieces.usable, pieces.byte_id))
    made: list[Pieces] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made.append(Pieces(*sent.value))
        pieces = made[0]
        for batch in batches:
            for first, offsets, data in chunks(batch.column(1), CHUNK):
                rows = len(offsets) - 1
                own = batch.column(0).slice(first, rows)
                ids, count = encode_texts(pieces, data, offsets, own.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), seed)
                back = gather(pieces.data, pieces.starts[ids], (pieces.ends - pieces.starts)[ids])
                body, _ = lay_out(data, offsets)
                same = _equal_rows(back, body, pieces, ids, count, offsets)
                yield pa.RecordBatch.from_arrays([own, ragged(ids, count, pa.int32()), pa.array(count), pa.array(np.diff(offsets)), pa.array(same)],
                                                 ["id", "ids", "n_ids", "n_bytes", "lossless"])
    return run


def _equal_rows(back, body, pieces, ids, count, offsets) -> np.ndarray:
    """Whether each row's ids decode to its text."""
    if len(back) == len(body) and (back == body).all():
        return np.ones(len(count), bool)
    at = np.concatenate([[0], np.cumsum(count)])
    _, rows = lay_out(np.zeros(offsets[-1], np.uint8), offsets)
    return np.array([pieces.decode(ids[a:b]) == body[x + 1:y].tobytes() for a, b, x, y in zip(at[:-1], at[1:], rows[:-1], rows[1:], strict=True)])


def sample_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL, seed: int = 42,
                  smoothing: float = 1.0) -> DataFrame:
    """One reproducible sampled segmentation of every text: id, ``ids``, ``n_ids``, ``n_bytes`` and ``lossless``.

    No piece crosses from a word into the next space or over a line feed, so a
    text's lattice falls apart into units. The lattice of each distinct unit is
    filtered forward once per batch; every occurrence is then sampled backward
    with random numbers that depend on nothing but ``seed``, the row's id, the
    unit's place in the text and the step: any partitioning gives the same ids.

    Characters without a piece are spelled in byte pieces, also the space mark
    itself when a text holds it, so decoding returns every text exactly;
    ``lossless`` tells so for each row.

    Defined results: null and empty texts have no ids; rows with equal id and
    text have equal ids; rows without an id share one stream of random numbers;
    an empty table gives an empty result. Only the two columns named are read.
    The vocabulary is read on the driver and is all that is broadcast.
    """
    pieces = Pieces.load(model, smoothing)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    return (slim.mapInArrow(_encode(docs.sparkSession, pieces, seed), "id long, ids array<int>, n_ids long, n_bytes long, lossless boolean")
            .withColumnRenamed("id", id_col))


def decode_pieces(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", model: str = MODEL) -> DataFrame:
    """The texts of id sequences: id and ``text``. Null sequences give empty texts."""
    pieces = Pieces.load(model)
    sent = encoded.sparkSession.sparkContext.broadcast(pieces.raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = sent.value
        for batch in batches:
            texts = [b"".join([raw[i] for i in ids])[1:].decode() if ids else "" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return (encoded.select(F.col(id_col).cast("long").alias("id"), F.col(ids_col).alias("ids"))
            .mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col))


def op9_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_pieces(table(spark, sf_dir, "documents"))
