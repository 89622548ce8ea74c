"""Removal of long byte strings that occur more than once, by suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import BYTE_CODES, GOLD, blobs, chunks, durable, grouped, mix, ragged, span_hashes, table, text_of
from lakeloom.llm.suffixes import common_prefixes, suffix_array

#: Windows in a segment at most; bytes in a shard; segments of one seed in a shard; keys in a merging task.
PIECE, SHARD_BYTES, SHARD_SEGMENTS, MERGE_KEYS = 1024, 2 << 20, 2000, 1 << 20
GRAM = 32
#: Windows looked at together; a position among them stands in the low bits of a gram hash.
SLICE, POS_BITS = 1 << 20, 21


def _gram_codes(data: np.ndarray) -> np.ndarray:
    """A hash of the 32 bytes from every position on."""
    x, width = BYTE_CODES[data], 1
    while width < GRAM:
        x = x[:-width] * (GOLD + np.uint64(2 * width)) + (x[width:] ^ (x[width:] >> np.uint64(29)))
        width *= 2
    return mix(x)


def _least(code: np.ndarray, w: int) -> np.ndarray:
    """The least of every ``w`` neighbours, by running minima of blocks from both ends."""
    grid = np.concatenate([code, np.full(-len(code) % w, np.uint64(2**64 - 1))]).reshape(-1, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(code) - w + 1
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def window_marks(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of ``length``-byte windows that have the same least gram hash.

    Gives row, hash, first window, windows, and whether the least gram stands
    more than once in the run, so that windows of the run may equal each other.
    Equal windows have the same least hash, so they stand in runs of one hash.
    """
    found = []
    ends, low = offsets[1:], np.uint64((1 << POS_BITS) - 1)
    for c in range(0, max(0, len(data) - length + 1), SLICE):
        part = data[c:c + SLICE + length - 1]
        code = _gram_codes(part) & ~low
        where = np.arange(len(code), dtype=np.uint64)
        left = _least(code | where, length - GRAM + 1)
        right = _least(code | (low - where), length - GRAM + 1)
        least = left >> np.uint64(POS_BITS)
        n = len(left)
        at = np.arange(c, c + n)
        row = np.searchsorted(ends, at, "right")
        good = at + length <= ends[np.minimum(row, len(ends) - 1)]
        first = good.copy()
        first[1:] &= ~good[:-1] | (least[1:] != least[:-1]) | (row[1:] != row[:-1])
        begin = np.flatnonzero(first)
        stop = np.flatnonzero(good & np.append(~good[1:] | first[1:], True)) + 1
        again = (left[begin] & low) != low - (right[stop - 1] & low)
        pieces = -(-(stop - begin) // PIECE)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        b = np.repeat(begin, pieces) + nth * PIECE
        e = np.minimum(np.repeat(stop, pieces), b + PIECE)
        found.append((row[b], least[b], b + c, e - b, np.repeat(again, pieces)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, bool))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _prints(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in chunks(batch.column(1)):
                rows = len(offsets) - 1
                row, code, lo, win, again = window_marks(data, offsets, length)
                per = np.bincount(row, minlength=rows)
                view = memoryview(data)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, rows),
                    blobs([hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]),
                    pa.array(np.diff(offsets)), ragged(code.view(np.int64), per, pa.int64()),
                    ragged(lo - offsets[row], per, pa.int64()), ragged(win.astype(np.int32), per, pa.int32()),
                    ragged(again, per, pa.bool_()),
                ], ["id", "digest", "n_bytes", "code", "lo", "win", "again"])
    return run


def _segments(length: int, with_bytes: bool):
    """Each run of windows that may be repeated, as a row: its seed, a name of its bytes, and where it stands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            hits = batch.column(names.index("hits"))
            digest, texts = batch.column(names.index("digest")), batch.column(names.index("text"))
            at = hits.offsets.to_numpy()
            seed, lo, win, again = (hits.values.field(k).to_numpy(zero_copy_only=False) for k in ("code", "lo", "win", "again"))
            for begin in range(0, batch.num_rows, 200):
                rows = range(begin, min(begin + 200, batch.num_rows))
                text = [memoryview(texts[r].as_buffer()) for r in rows]
                out, raw, who = [], [], []
                for r, body in zip(rows, text, strict=True):
                    for k in range(at[r], at[r + 1]):
                        piece = bytes(body[lo[k]:lo[k] + win[k] + length - 1])
                        out.append(hashlib.blake2b(piece, digest_size=16).digest())
                        raw.append(piece if with_bytes else None)
                        who.append(r)
                a, b = at[rows[0]], at[rows[-1] + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed[a:b]), blobs(out), blobs(raw), digest.take(pa.array(who, pa.int64())), pa.array(lo[a:b]), pa.array(win[a:b]),
                     pa.array(again[a:b])],
                    ["seed", "name", "bytes", "digest", "lo", "win", "again"])
    return run


_FOUND = "name binary, first array<int>, last array<int>, seed long, sub int, range int, keys binary, names binary, offs binary"


def _found(names, runs, keyed=()) -> pa.RecordBatch:
    per = np.array([len(r[0]) for r in runs], np.int64)
    flat = [np.concatenate([r[k] for r in runs]) if len(runs) else np.zeros(0, np.int64) for k in (0, 1)]
    none = [None] * len(runs)
    lists = [pa.concat_arrays([ragged(f.astype(np.int32), per, pa.int32()), pa.nulls(len(keyed), pa.list_(pa.int32()))]) for f in flat]
    col = lambda k, kind: pa.array(none + [x[k] for x in keyed], kind)
    return pa.RecordBatch.from_arrays(
        [blobs(list(names) + [None] * len(keyed)), *lists, col(0, pa.int64()), col(1, pa.int32()), col(2, pa.int32()),
         col(3, pa.binary()), col(4, pa.binary()), col(5, pa.binary())],
        ["name", "first", "last", "seed", "sub", "range", "keys", "names", "offs"])


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _shard(rows: list[tuple], length: int) -> pa.RecordBatch:
    """Suffix array, common prefixes and repeated windows of one shard.

    rows: (seed, sub, ranges, name, bytes, windows). Where ``ranges`` is over 0
    the seed has further shards; then one 128-bit key for each distinct window
    goes out too, by key range, for the merge.
    """
    size = np.array([len(r[4]) for r in rows])
    ends = np.cumsum(size)
    starts = ends - size
    data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    left = (np.repeat(ends, size) - np.arange(len(data))).astype(np.int64)
    win = np.array([r[5] for r in rows], np.int64)
    sa, key = suffix_array(data, left)
    before, shared = common_prefixes(sa, key, left, starts, win, length)
    twice = np.flatnonzero(shared >= length)
    mask = np.zeros(len(data), bool)
    mask[twice] = mask[before[twice]] = True
    names, runs, keyed = [], [], []
    for r, s, w in zip(rows, starts.tolist(), win.tolist(), strict=True):
        first, last = _runs(mask[s:s + w])
        if len(first):
            names.append(r[3])
            runs.append((first, last))
    split = {r[:3] for r in rows if r[2]}
    if split:
        own = np.repeat(np.arange(len(rows)), win)
        at = np.repeat(starts, win) + np.arange(win.sum()) - np.repeat(np.cumsum(win) - win, win)
        keep = (shared[at] < length) & np.isin(own, [k for k, r in enumerate(rows) if r[2]])  # the first of each class in suffix order
        own, at = own[keep], at[keep]
        hi = span_hashes(data, at, at + length)
        lo = span_hashes(data ^ np.uint8(0x5A), at, at + length)
        group = np.array([hash(r[:3]) for r in rows])
        for g in split:
            mine = np.flatnonzero(group[own] == hash(g))
            mine = mine[np.argsort(hi[mine])]
            part = ((hi[mine] >> np.uint64(32)) * np.uint64(g[2])) >> np.uint64(32)
            for k in np.unique(part).tolist():
                m = mine[part == k]
                keyed.append((g[0], g[1], int(k), np.stack([hi[m], lo[m]], 1).tobytes(),
                              b"".join(rows[o][3] for o in own[m].tolist()), (at[m] - starts[own[m]]).astype(np.int32).tobytes()))
    return _found(names, runs, keyed)


def _shards(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("seed", "sub", "ranges", "name", "bytes", "win")), strict=True):
                if size >= SHARD_BYTES and row[:2] != last:
                    yield _shard(held, length)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[:2]
        if held:
            yield _shard(held, length)
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that several shards of one seed hold, found by binary search of each sorted list in the union."""
    for group in grouped(batches, ["seed", "range"]):
        lists = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in group["keys"].to_pylist()]
        base, twice = np.zeros((0, 2), np.uint64), np.zeros(0, bool)
        for own in lists:
            at = np.searchsorted(base[:, 0], own[:, 0])
            inside = np.minimum(at, max(len(base) - 1, 0))
            hit = (at < len(base)) & (base[inside] == own).all(1) if len(base) else np.zeros(len(own), bool)
            twice[at[hit]] = True
            base = np.insert(base, at[~hit], own[~hit], 0)
            twice = np.insert(twice, at[~hit], False)
        names, runs = [], []
        for own, name, off in zip(lists, group["names"].to_pylist(), group["offs"].to_pylist(), strict=True):
            hit = np.flatnonzero(twice[np.searchsorted(base[:, 0], own[:, 0])])
            off = np.frombuffer(off, np.int32)
            for k in hit.tolist():
                names.append(name[16 * k:16 * k + 16])
                runs.append((off[k:k + 1], off[k:k + 1] + 1))
        yield _found(names, runs)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            digest, texts, cuts = (batch.column(names.index(c)) for c in ("digest", "text", "cuts"))
            out = []
            for r in range(batch.num_rows):
                body = texts[r].as_py()
                pairs = np.array([(c["a"], c["b"]) for c in cuts[r].as_py()], np.int64)
                pairs = pairs[np.argsort(pairs[:, 0])]
                top = np.maximum.accumulate(pairs[:, 1])
                new = np.append(True, pairs[1:, 0] > top[:-1])
                a, b = pairs[new, 0], top[np.append(np.flatnonzero(new)[1:] - 1, len(top) - 1)]
                edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(body)]
                kept = b"".join(body[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
                out.append((digest[r].as_py(), int((b - a).sum()), [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)],
                            kept, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
            yield pa.RecordBatch.from_arrays([
                blobs([x[0] for x in out]), pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                blobs([x[3] for x in out]), pa.array([x[4] for x in out], pa.string()), pa.array([x[5] for x in out], pa.string()),
            ], ["digest", "n_removed", "spans", "kept", "kept_sha256", "kept_text"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """Each text without the bytes that a repeated string of ``length`` bytes covers.

    Returns one row per input row: the id, ``n_bytes``, ``n_removed``,
    ``n_spans``, ``spans`` (maximal removed runs as byte offsets), ``kept``
    (the remaining bytes; null where nothing goes), ``kept_text`` (the same
    without characters that a cut divides), ``digest`` (SHA-256 of the whole
    text) and ``kept_sha256``.

    1. Every window has a least hash among its 32-byte grams. Equal windows
       have equal least hashes, so runs of windows with one such seed are all
       that must be compared, and a seed seen once in the corpus cannot be part
       of a repeat. Only names and counts of seeds are shuffled.
    2. Runs of the remaining seeds become segments; equal segments are counted
       on the map side. Distinct segments of a seed go to one shard, or, where
       a seed has very many, to several.
    3. A shard builds its suffix array by Larsson-Sadakane doubling, its common
       prefixes by Kasai's walk, and marks windows whose neighbour in suffix
       order shares ``length`` bytes. Shards of one seed are merged by binary
       search of their sorted lists of distinct windows (128-bit names).
    4. Marked windows return to the texts that hold them, which are cut.

    Defined results: null texts are empty; texts shorter than ``length`` stay
    whole; rows with the same text are occurrences of each other, so a copied
    text of ``length`` bytes or more goes completely, whichever id it has, null
    included. No match spans two rows. An empty table gives an empty result.
    Cuts are made at bytes and may divide a character. Only the two columns
    named are read.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).cast("binary").alias("text"))
    prints = durable(slim.mapInArrow(_prints(length), "id long, digest binary, n_bytes long, code array<long>, lo array<long>, win array<int>, again array<boolean>"), "prints")
    none = F.lit(-(2**63)).cast("long")
    classes = durable(prints.groupBy("digest").agg(
        F.min(F.coalesce("id", none)).alias("rep"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"),
        F.first("code").alias("code"), F.first("lo").alias("lo"), F.first("win").alias("win"), F.first("again").alias("again")), "classes")
    marks = classes.select("digest", "rep", F.explode(F.arrays_zip("code", "lo", "win", "again")).alias("m")).select("digest", "rep", "m.*")
    seeds = durable(marks.groupBy("code").agg(F.count("*").alias("n"), F.max("again").alias("again")).filter("n > 1 OR again").select("code"), "seeds")
    hits = marks.join(seeds, "code").groupBy("digest", "rep").agg(F.collect_list(F.struct("code", "lo", "win", "again")).alias("hits"))
    own = slim.withColumn("rep", F.coalesce("id", none)).withColumn("sha", F.unhex(F.sha2("text", 256)))
    cand = durable(own.join(hits.hint("merge"), (own.rep == hits.rep) & (own.sha == hits.digest)).select("digest", "text", "hits"), "candidates")
    shape = "seed long, name binary, bytes binary, digest binary, lo long, win int, again boolean"
    places = durable(cand.mapInArrow(_segments(length, False), shape).drop("bytes"), "places")
    segments = (cand.mapInArrow(_segments(length, True), shape).groupBy("seed", "name")
                .agg(F.first("bytes").alias("bytes"), F.first("win").alias("win")))
    counted = places.groupBy("seed", "name").agg(F.first("win").alias("win"), F.max("again").alias("again"), F.min(F.struct("digest", "lo")).alias("a"), F.max(F.struct("digest", "lo")).alias("b"))
    counted = durable(counted.select("seed", "name", "win", "again", (F.col("a") != F.col("b")).alias("multi")), "counted")
    seeded = durable(counted.groupBy("seed").agg(F.count("*").alias("n"), F.sum("win").alias("wins"), F.max("again").alias("again"))
                     .filter("n > 1 OR again"), "seeded")
    subs = F.ceil(F.col("n") / SHARD_SEGMENTS).cast("int")
    shards = (segments.join(seeded, "seed")
              .select("seed", F.pmod(F.xxhash64("name"), subs).cast("int").alias("sub"),
                      F.when(subs > 1, F.ceil(F.col("wins") / MERGE_KEYS)).otherwise(0).cast("int").alias("ranges"), "name", "bytes", "win")
              .repartition("seed", "sub").sortWithinPartitions("seed", "sub"))
    marked = durable(shards.mapInArrow(_shards(length), _FOUND), "marked")
    merged = (marked.filter("keys IS NOT NULL").repartition("seed", "range").sortWithinPartitions("seed", "range")
              .mapInArrow(_merge, _FOUND))
    runs = (marked.filter("name IS NOT NULL").select("name", F.explode(F.arrays_zip("first", "last")).alias("r")).select("name", "r.first", "r.last")
            .union(merged.select("name", F.col("first")[0], F.col("last")[0]))
            .union(counted.filter("multi").select("name", F.lit(0), "win")))
    cuts = (places.select("name", "digest", "lo").join(runs, "name")
            .groupBy("digest").agg(F.collect_set(F.struct((F.col("lo") + F.col("first")).alias("a"),
                                                          (F.col("lo") + F.col("last") + (length - 1)).alias("b"))).alias("cuts")))
    changed = (cand.select("digest", "text").join(cuts, "digest")
               .mapInArrow(_cut(length), "digest binary, n_removed long, spans array<struct<start:long,end:long>>, kept binary, kept_sha256 string, kept_text string")
               .dropDuplicates(["digest"]))
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    per_text = classes.select("digest", copied.alias("copied")).join(changed, "digest", "left").filter("copied OR n_removed IS NOT NULL")
    return (prints.select("id", "digest", "n_bytes").join(per_text, "digest", "left")
            .withColumn("copied", F.coalesce("copied", F.lit(False)))
            .withColumn("spans", F.when(F.col("copied"), whole).otherwise(F.coalesce("spans", F.expr("array()"))))
            .select(F.col("id").alias(id_col), "n_bytes",
                    F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.size("spans").cast("long").alias("n_spans"), "spans",
                    F.when(F.col("copied"), F.unhex(F.lit(""))).otherwise(F.col("kept")).alias("kept"),
                    F.when(F.col("copied"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"), "digest",
                    F.when(F.col("copied"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256")))


def op5_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


ORACLE = {"op5_suffix_array_dedup": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT r, doc_id, b, octet_length(b) AS n_bytes FROM d),
w AS MATERIALIZED (SELECT r, i, md5(hex(array_slice(b, i, i + 399))) AS h FROM (SELECT r, b, unnest(range(1, n_bytes - 398)) AS i FROM n WHERE n_bytes >= 400)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM twice)),
edge AS (SELECT r, i, CASE WHEN i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400 OR lag(i) OVER (PARTITION BY r ORDER BY i) IS NULL THEN 1 ELSE 0 END AS f FROM hit),
run AS (SELECT r, i, sum(f) OVER (PARTITION BY r ORDER BY i) AS k FROM edge),
span AS (SELECT r, k, min(i) AS a, max(i) + 400 AS z FROM run GROUP BY r, k),
piece AS (SELECT r, k, lag(z, 1, 1) OVER (PARTITION BY r ORDER BY k) AS a, a AS z FROM span),
tail AS (SELECT r, max(k) + 1 AS k, max(z) AS a, NULL::BIGINT AS z FROM span GROUP BY r),
kept AS (SELECT p.r, string_agg(CASE WHEN coalesce(p.z, n.n_bytes + 1) > p.a THEN hex(array_slice(n.b, p.a, coalesce(p.z, n.n_bytes + 1) - 1)) ELSE '' END, '' ORDER BY p.k) AS x
  FROM (SELECT * FROM piece UNION ALL SELECT * FROM tail) p JOIN n USING (r) GROUP BY p.r),
per AS (SELECT r, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN kept.r IS NULL THEN b ELSE unhex(x) END) AS kept_sha256
FROM n LEFT JOIN per USING (r) LEFT JOIN kept USING (r)"""}
