"""Alignment of two tokenizers' ids over the same texts."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import durable, ragged, table, text_of

DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BYTE_BPE, PIECE_BPE = os.path.join(DIR, "byte_bpe_50k.json"), os.path.join(DIR, "piece_bpe_32k.model")
#: Units remembered in a task, characters of a unit that is remembered, bytes of text aligned together, and of a block of texts.
REMEMBERED, LONGEST, AT_ONCE, BLOCK = 1 << 18, 24, 1 << 20, 4 << 20
_MARK = "▁"
# Fixed value: how byte-level texts are divided before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where both tokenizers always cut: before a space that follows anything but white space.
_CUT = re.compile(r"(?<=\S)(?= )")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=4)
def byte_level_ranks(path: str) -> tuple[tuple[bytes, ...], dict[bytes, int]]:
    """Bytes of every id of a byte-level BPE file, and ids by bytes as merge ranks.

    Ranks alone, without the list of merged pairs, give the same ids: every
    token is made by one merge whose place in the list is that of its id (checked),
    and a token that its own bytes are not merged to is made nowhere, as merges
    inside its bytes do not depend on what surrounds them; such tokens are left out.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    letters = byte_letters()
    with open(path, encoding="utf-8") as file:
        told = json.load(file)["model"]
    raw = [b""] * (max(told["vocab"].values()) + 1)
    ranks = {}
    for token, i in told["vocab"].items():
        if all(c in letters for c in token):
            raw[i] = bytes(letters[c] for c in token)
            if len(token) == 1 or [t.id for t in model.tokenize(token)] == [i]:
                ranks[raw[i]] = i
    order = [told["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in told["merges"]]
    if order != sorted(order):
        raise ValueError(f"merges of {path} are not in the order of ids")
    return tuple(raw), ranks


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file; special tokens are plain text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.raw, ranks = byte_level_ranks(path)
        self.model = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, units: list[str]) -> list[list[int]]:
        return [self.model.encode_ordinary(u) for u in units]


class PieceLevel:
    """Ids and token bytes of a SentencePiece file that puts a space before the text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw, self.single = [], True
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.raw.append(bytes([int(piece[3:5], 16)]))
            elif self.model.is_control(i) or self.model.is_unknown(i):
                self.raw.append(b"")
            else:
                self.raw.append(piece.replace(_MARK, " ").encode())
                self.single &= _MARK not in piece.lstrip(_MARK)
        self.space = [self.model.piece_to_id(_MARK)]

    def encode(self, units: list[str]) -> list[list[int]]:
        """Units begin with the space that the model adds; of a lone space it would add none."""
        return [ids if unit != " " else self.space for unit, ids in
                zip(units, self.model.encode([u[1:] for u in units], num_threads=1), strict=True)]


def common_ends(a: list[int], b: list[int], size_a: list[int], size_b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Where two id lists of the same bytes can be cut together: end bytes, ids of a before each, ids of b before each.

    Each list's cumulative ends are held in a dictionary from end to index; the
    common keys, sorted, are the cuts. Of ids without bytes the last one counts.
    """
    at_a = dict(zip(accumulate(map(size_a.__getitem__, a)), count(1)))
    at_b = dict(zip(accumulate(map(size_b.__getitem__, b)), count(1)))
    ends = sorted(at_a.keys() & at_b.keys())
    return ends, list(map(at_a.__getitem__, ends)), list(map(at_b.__getitem__, ends))


def ending(ids: list[int], to: int, size: list[int]) -> list[int]:
    """The ids whose bytes end where those of id number ``to`` do, from the last back: one, and more only behind ids without bytes."""
    found = [ids[to - 1]]
    while not size[found[-1]] and len(found) < to:
        found.append(ids[to - 1 - len(found)])
    return found


#: What a text or unit adds: ids of a, of b, groups, the groups as ``a1,a2|b1;``, and linked pairs as the bytes of 64-bit numbers.
Aligned = tuple[int, int, int, str, bytes]
NOTHING: Aligned = (0, 0, 0, "", b"")


class Aligner:
    """Encodes texts unit by unit, remembers units, and aligns ids.

    Neither tokenizer has a token over a space that follows anything but white
    space: the byte-level pattern ends there, and no piece holds a space mark
    behind another letter (checked; otherwise whole texts are units). So ids of
    a text are those of its units one after the other.
    """

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), PieceLevel(path_b)
        self.size_a, self.size_b = [len(r) for r in self.a.raw], [len(r) for r in self.b.raw]
        self.bare = np.array(self.size_a) == 0, np.array(self.size_b) == 0
        # each id with the sign behind it: a comma, or what ends its side of a group
        self.told = [f"{i}{sign}" for signs, n in ((",|", len(self.size_a)), (",;", len(self.size_b))) for i in range(n) for sign in signs]
        self.known: dict[str, Aligned] = {}

    def units(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.b.single else [" " + text]

    def encode(self, units: list[str]) -> list[tuple[list[int], list[int]]]:
        """Both sides' ids of texts that begin with a space; none where either side does not spell the text."""
        ids_a, ids_b = self.a.encode(units), self.b.encode(units)
        bodies = [u.encode() for u in units]
        if self._spelled(bodies, ids_a, self.a.raw, self.size_a) and self._spelled(bodies, ids_b, self.b.raw, self.size_b):
            return list(zip(ids_a, ids_b, strict=True))
        return [(a, b) if b"".join([self.a.raw[i] for i in a]) == body == b"".join([self.b.raw[i] for i in b]) else ([], [])
                for body, a, b in zip(bodies, ids_a, ids_b, strict=True)]

    @staticmethod
    def _spelled(bodies: list[bytes], ids: list[list[int]], raw: tuple[bytes, ...], size: list[int]) -> bool:
        """Whether all ids together have the bytes of all units, and each unit as many as its own."""
        flat = list(chain.from_iterable(ids))
        if b"".join(map(raw.__getitem__, flat)) != b"".join(bodies):
            return False
        upto = np.append(0, np.cumsum(np.fromiter(map(size.__getitem__, flat), np.int64, len(flat))))
        return np.array_equal(upto[np.cumsum(list(map(len, ids)))], np.cumsum(list(map(len, bodies))))

    def align(self, units: list[str]) -> list[Aligned]:
        """What each of some units adds to its text; all are laid end to end, as their ends are cuts of both sides."""
        ids = self.encode(units)
        a, b = list(chain.from_iterable([x for x, _ in ids])), list(chain.from_iterable([y for _, y in ids]))
        if not a:
            return [NOTHING] * len(units)
        _, cut_a, cut_b = common_ends(a, b, self.size_a, self.size_b)
        cuts_a, cuts_b, flat_a, flat_b = np.array(cut_a), np.array(cut_b), np.array(a, np.int64), np.array(b, np.int64)
        told = self.spell(flat_a, flat_b, cuts_a, cuts_b)
        n_a, n_b = np.array([len(x) for x, _ in ids]), np.array([len(y) for _, y in ids])
        to_a, to_b = np.cumsum(n_a), np.cumsum(n_b)
        to_group = np.searchsorted(cuts_a, to_a, "right")
        if self.bare[0][flat_a].any() or self.bare[1][flat_b].any():
            per = [[x << 32 | y for x in ending(a, p, self.size_a) for y in ending(b, q, self.size_b)] for p, q in zip(cut_a, cut_b, strict=True)]
            links, links_upto = np.array(list(chain.from_iterable(per)), np.int64), np.append(0, np.cumsum(list(map(len, per))))
        else:  # one id of either side ends where its slice does
            links, links_upto = flat_a[cuts_a - 1] << 32 | flat_b[cuts_b - 1], np.arange(len(cut_a) + 1)
        out, from_told, from_group = [], 0, 0
        for na, nb, told_to, group in zip(n_a.tolist(), n_b.tolist(), (to_a + to_b).tolist(), to_group.tolist(), strict=True):
            out.append((na, nb, group - from_group, "".join(told[from_told:told_to]), links[links_upto[from_group]:links_upto[group]].tobytes()) if na else NOTHING)
            from_told, from_group = told_to, group
        return out

    def tell(self, texts: list[str]) -> list[Aligned]:
        """What ``align`` says of whole texts, put together from their units; NOTHING for texts not spelled by both."""
        split = [self.units(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({u for units in split for u in units if u not in known})
        fresh = dict(zip(new, self.align(new), strict=True)) if new else {}
        known.update(fresh)
        found = []
        for units in split:
            n_a, n_b, groups, told, links = zip(*map(known.__getitem__, units)) if units else ((0,),) * 5
            found.append((sum(n_a), sum(n_b), sum(groups), "".join(told), b"".join(links)) if 0 not in n_a else NOTHING)
        for unit in fresh:
            if len(unit) > LONGEST:
                del known[unit]
        return found

    def spell(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> list[str]:
        """Every id with the sign behind it, in the order of ``a1,a2|b1;a3|b2,b3;``."""
        code_a, code_b = 2 * a, 2 * b + 2 * len(self.size_a)
        code_a[cut_a - 1] += 1
        code_b[cut_b - 1] += 1
        out = np.empty(len(a) + len(b), np.int64)  # a group's ids of a stand behind the ids of b of earlier groups
        out[np.arange(len(a)) + np.repeat(np.append(0, cut_b[:-1]), np.diff(cut_a, prepend=0))] = code_a
        out[np.arange(len(b)) + np.repeat(cut_a, np.diff(cut_b, prepend=0))] = code_b
        return list(map(self.told.__getitem__, out.tolist()))


def _texts(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts in parts of about ``limit`` bytes; a text is never divided."""
    for batch in batches:
        size = np.cumsum(pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + limit, "right")))
            yield batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at).to_pylist()
            at = to


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))


def align_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str = BYTE_BPE, path_b: str = PIECE_BPE) -> DataFrame:
    """The ids of both tokenizers for every text, and where both end a token.

    Returns one row per input row: the id, ``a_ids``, ``b_ids``, and ``groups``
    of (end, a_to, b_to): up to byte ``end`` of the text with one space before
    it, the first ``a_to`` and ``b_to`` ids hold the same bytes. A group begins
    where the one before it ends.

    Both vocabularies spell a space before the text. Ids are found once for
    each distinct unit of text that a task meets, cumulative ends are looked up
    in dictionaries, and their sorted intersection slices both id lists.

    Defined results: null and empty texts, and texts that either tokenizer does
    not spell exactly (with a space mark in them, say), have empty lists;
    special tokens in a text are plain text; repeated rows give equal rows; rows
    without an id stay; an empty table gives an empty result. Only the two
    columns named are read. The files of both vocabularies must be at the same
    path on every worker.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for own, texts in _texts(batches, AT_ONCE):
            rows_a, rows_b, cuts = [], [], []
            for a, b in aligner.encode([" " + t if t else "" for t in texts]):
                rows_a.append(a)
                rows_b.append(b)
                cuts.append([{"end": e, "a_to": x, "b_to": y} for e, x, y in zip(*common_ends(a, b, aligner.size_a, aligner.size_b), strict=True)])
            yield pa.RecordBatch.from_arrays([own, pa.array(rows_a, pa.list_(pa.int32())), pa.array(rows_b, pa.list_(pa.int32())), pa.array(cuts, _CUTS)],
                                             ["id", "a_ids", "b_ids", "groups"])

    shape = "id long, a_ids array<int>, b_ids array<int>, groups array<struct<end:long,a_to:int,b_to:int>>"
    return _slim(docs, id_col, text_col).mapInArrow(run, shape).withColumnRenamed("id", id_col)


_CUTS = pa.list_(pa.struct([("end", pa.int64()), ("a_to", pa.int32()), ("b_to", pa.int32())]))
_BLOCKS = ("digest binary, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>")


def _summaries(path_a: str, path_b: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        block, held = TaskContext.get().partitionId() << 32, 0
        for own, texts in _texts(batches, AT_ONCE):
            found = aligner.tell(texts)
            told = [hashlib.sha256(x[3][:-1].encode()).hexdigest() if x[3] else "" for x in found]
            links = [np.frombuffer(x[4], np.int64) for x in found]
            size = np.array([len(x) for x in links], np.int64)
            pair, times = zip(*(np.unique(x, return_counts=True) for x in links), strict=True)
            each = np.array([len(x) for x in pair], np.int64)
            yield pa.RecordBatch.from_arrays(
                [own, pa.array(np.full(len(links), block)), *(pa.array([x[k] for x in found], pa.int64()) for k in range(3)), pa.array(size), pa.array(told, pa.string()),
                 ragged(np.concatenate(pair), each, pa.int64()), ragged(np.concatenate(times).astype(np.int32), each, pa.int32())],
                ["digest", "block", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
            held += sum(map(len, texts))
            if held >= BLOCK:
                block, held = block + 1, 0
    return run


def _with_counts(keys: tuple, rows: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Sums over the links of each row of a block, from the counts of the block's pairs."""
    counts = counts.sort_values("pair")
    pair, total, best = counts["pair"].to_numpy(), counts["total"].to_numpy(), counts["best"].to_numpy()
    n_best, sums = [], []
    for own, times in zip(rows["pairs"], rows["times"], strict=True):
        at = np.searchsorted(pair, own)
        n_best.append(int(times[best[at]].sum()))
        sums.append(int((times * total[at]).sum()))
    return rows.drop(columns=["block", "pairs", "times"]).assign(n_best=n_best, count_sum=sums)


def alignment_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str = BYTE_BPE, path_b: str = PIECE_BPE) -> DataFrame:
    """How the ids of two tokenizers meet, text by text, with counts over all texts.

    Returns one row per input row: the id, ``n_a`` and ``n_b`` ids, ``n_groups``,
    ``n_links`` (pairs of an id of a and one of b whose bytes end together),
    ``groups_sha256`` (of ``a1,a2|b1;a3|b2,b3``), ``n_best`` (links whose pair
    is the most frequent of its b id over all texts, ties included) and
    ``count_sum`` (the sum of the links' counts over all texts).

    Distinct texts are aligned once and count as often as they occur. They lie
    in blocks of some megabytes; a block holds each of its pairs once, so a pair
    that stands in every text has one row a block in the count and in the join
    that brings counts back, and no table of counts is collected or broadcast.
    Blocks are then put together with their counts, one at a time.

    Null, empty and other texts without ids, repeated rows, missing ids and
    empty tables: as ``align_tokens``; ``groups_sha256`` is empty and all
    numbers are 0 where there are no ids.
    """
    own = _slim(docs, id_col, text_col).withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    texts = own.groupBy("digest").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = durable(texts, "texts")
    rows = durable(texts.select("digest", "text").mapInArrow(_summaries(path_a, path_b), _BLOCKS), "aligned")
    weighed = rows.join(texts.filter("copies > 1").select("digest", "copies"), "digest", "left")
    blocks = durable(weighed.select("block", F.coalesce("copies", F.lit(1)).alias("copies"), F.explode(F.arrays_zip("pairs", "times")).alias("l"))
                     .groupBy("block", F.col("l.pairs").alias("pair")).agg(F.sum(F.col("l.times") * F.col("copies")).alias("n")), "pairs")
    totals = durable(blocks.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    highest = totals.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("total").alias("high"))
    judged = totals.withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF)).join(highest, "b").select("pair", "total", (F.col("total") == F.col("high")).alias("best"))
    counts = blocks.select("block", "pair").join(judged, "pair")
    numbers = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    shape = "digest binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    summed = rows.filter("n_links > 0").groupBy("block").cogroup(counts.groupBy("block")).applyInPandas(_with_counts, shape)
    none = rows.filter("n_links = 0").select("digest", *[F.lit("" if c == "groups_sha256" else 0).cast("string" if c == "groups_sha256" else "long").alias(c) for c in numbers])
    per_text = durable(summed.unionByName(none), "summed")
    return own.select("id", "digest").join(per_text, "digest").select(F.col("id").alias(id_col), *numbers)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(table(spark, sf_dir, "documents"))
