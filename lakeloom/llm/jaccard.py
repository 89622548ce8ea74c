"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import (GOLD, components, durable, gram_hashes, grouped, link_rows, mix, ragged, row_counts,
                                 span_hashes, spans, table, text_of, tie_up)
from lakeloom.llm.common import chunks as text_chunks

#: A verifying task holds two blocks of at most so many n-grams and sets.
BLOCK_GRAMS, BLOCK_SETS = 400_000, 800


def choose_bands(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows: the most rows whose recall at the threshold still reaches the target.

    A pair of similarity s shares a band with probability 1-(1-s**rows)**bands.
    """
    best = (hashes, 1)
    for rows in range(1, hashes + 1):
        bands = hashes // rows
        if bands and 1 - (1 - threshold**rows) ** bands >= recall:
            best = (bands, rows)
    return best


def _prepared(offsets: np.ndarray, data: np.ndarray, n: int):
    starts, ends = spans(data, offsets)
    counts = row_counts(starts, offsets)
    words = span_hashes(data, starts, ends)
    grams, have = gram_hashes(words, counts, n)
    return words, counts, grams, have


def _keys(words: np.ndarray, counts: np.ndarray) -> list[bytes | None]:
    """A 128-bit name of each row's word sequence; none for rows without words."""
    at = np.concatenate([[0], np.cumsum(counts)])
    raw = words.tobytes()
    return [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def minhash_bands(grams: np.ndarray, have: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes, one row per set that is not empty."""
    full = have[have > 0]
    at = np.cumsum(full) - full
    x = (grams >> np.uint64(32)).astype(np.uint32)
    rng = np.random.Generator(np.random.PCG64(11))
    mul = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    xor = rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    out = np.empty((len(full), bands), np.uint64)
    room = np.empty_like(x)
    for band in range(bands):
        h = np.full(len(full), band + 1, np.uint64) * GOLD
        for k in range(band * rows, band * rows + rows):
            np.bitwise_xor(x, xor[k], out=room)
            np.multiply(room, mul[k], out=room)
            h = mix(h ^ np.minimum.reduceat(room, at).astype(np.uint64))
        out[:, band] = h
    return out


def _signatures(n: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in text_chunks(batch.column(1)):
                words, counts, grams, have = _prepared(offsets, data, n)
                sig = minhash_bands(grams, have, bands, rows) if len(grams) else np.zeros((0, bands), np.uint64)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(counts)),
                    pa.array(_keys(words, counts), pa.binary()),
                    pa.array(have.astype(np.int64)),
                    ragged(sig.ravel().view(np.int64), np.where(have > 0, bands, 0), pa.int64()),
                ], ["id", "key", "grams", "bands"])
    return run


def _blocks(n: int):
    """The n-gram set of each candidate, once for every pair of blocks that its block is part of."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {c: batch.column(c) for c in ("id", "key", "comp", "size", "blocks", "block")}
            for first, offsets, data in text_chunks(batch.column("text")):
                words, counts, grams, have = _prepared(offsets, data, n)
                keys = _keys(words, counts)
                at = np.concatenate([[0], np.cumsum(have)])
                rows = {k: [] for k in ("comp", "bi", "bj", "block", "id", "size", "set")}
                for i, key in enumerate(keys):
                    take = {c: v[first + i].as_py() for c, v in cols.items()}
                    if key != take["key"]:
                        continue  # another text under the same id
                    own = np.unique(grams[at[i]:at[i + 1]]).tobytes()
                    for other in range(take["blocks"]):
                        rows["comp"].append(take["comp"])
                        rows["bi"].append(min(other, take["block"]))
                        rows["bj"].append(max(other, take["block"]))
                        rows["set"].append(own)
                        for c in ("block", "id", "size"):
                            rows[c].append(take[c])
                yield pa.RecordBatch.from_arrays([
                    pa.array(rows["comp"], pa.int64()), pa.array(rows["bi"], pa.int32()), pa.array(rows["bj"], pa.int32()),
                    pa.array(rows["block"], pa.int32()), pa.array(rows["id"], pa.int64()), pa.array(rows["size"], pa.int64()), pa.array(rows["set"], pa.binary()),
                ], list(rows))
    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many members each two sets share: rare members pair by pair, common ones by a matrix product."""
    n = len(sets)
    owner = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    cut = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    size = np.diff(np.append(cut, len(values)))
    both = np.zeros((n, n), np.float32)
    flat = both.ravel()
    rare = max(2, n // 16)
    for p in np.unique(size[(size > 1) & (size <= rare)]).tolist():
        i, j = np.triu_indices(p, 1)
        where = cut[size == p]
        step = max(1, 2_000_000 // len(i))
        for k in range(0, len(where), step):
            who = owner[where[k:k + step, None] + np.arange(p)]
            flat += np.bincount(who[:, i].astype(np.int64).ravel() * n + who[:, j].ravel(), minlength=n * n).astype(np.float32)
    where = np.flatnonzero(size > rare)
    for k in range(0, len(where), 2048):
        part = where[k:k + 2048]
        mark = np.zeros((n, len(part)), np.float32)
        rows = np.concatenate([owner[cut[w]:cut[w] + size[w]] for w in part])
        mark[rows, np.repeat(np.arange(len(part)), size[part])] = 1
        both += np.triu(mark @ mark.T, 1)
    return both


def _verify(threshold: Fraction):
    up, down = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in grouped(batches, ["comp", "bi", "bj"]):
            ids = group["id"].to_numpy()
            raw = group["set"].to_pylist()
            keep = list({(i, s): k for k, (i, s) in enumerate(zip(ids.tolist(), raw, strict=True))}.values())
            if len(keep) < 2:
                continue
            ids, size = ids[keep], group["size"].to_numpy()[keep]
            block = group["block"].to_numpy()[keep]
            sets = [np.frombuffer(raw[k], np.uint64) for k in keep]
            n = np.array([len(s) for s in sets])
            shared = shared_counts(sets)
            i, j = np.nonzero(shared)
            c = shared[i, j].astype(np.int64)
            hit = c * (up + down) >= up * (n[i] + n[j])
            if group["bi"][0].as_py() != group["bj"][0].as_py():
                hit &= block[i] != block[j]
            i, j = i[hit], j[hit]
            out += tie_up(ids, size, i, j)
            if len(out) > 20_000:
                yield link_rows(out)
                out = []
        yield link_rows(out)
    return run


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                       threshold: float = 0.8, recall: float = 0.9999, hashes: int = 256) -> DataFrame:
    """Documents whose sets of ``n`` consecutive words have a Jaccard similarity of ``threshold`` or more.

    Returns one row per input row: the id, ``class_id`` (smallest id with the
    same words), ``n_links`` (other rows linked directly, copies included),
    ``component_id`` (smallest id reachable by links) and ``kept`` (id =
    component_id).

    1. One pass turns each text into a name of its word sequence and band
       hashes; bands and rows are the widest that reach ``recall`` at the
       threshold (99.99 % with 256 hashes: 42 bands of 6). Copies meet in one
       class by a plain aggregate, so only one text of each goes on.
    2. Band hashes are shuffled; a band shared by several classes ties them to
       its smallest id. That is one row per class and band, never a pair list.
    3. Ties give groups of candidates. All pairs in a group are compared on
       their full n-gram sets, in blocks of bounded size: a task holds two
       blocks, gives counts per class and a spanning tree of the links found.

    Defined results: words are what white space separates, in lower case. A
    text of fewer than ``n`` words has one n-gram, all of it. Null and empty
    texts, and rows without an id, link with nothing. Repeated rows are copies
    and count as links. An empty table gives an empty result. Only the two
    columns named are read, so other columns may have any names.
    """
    bands, rows = choose_bands(threshold, recall, hashes)
    exact = Fraction(str(threshold))
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col, lower=True).alias("text"))
    sigs = durable(slim.mapInArrow(_signatures(n, bands, rows), "id long, key binary, grams long, bands array<long>"), "signatures")
    named = sigs.filter("id IS NOT NULL AND key IS NOT NULL")
    classes = durable(named.groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("size"),
                                               F.first("grams").alias("grams"), F.first("bands").alias("bands")), "classes")
    band = classes.select("rep", F.explode("bands").alias("band"))
    shared = durable(band.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high"), "shared")
    ties = band.join(shared.select("band", "low"), "band").filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b"))
    cand = durable(components(ties).select(F.col("id").alias("rep"), F.col("component").alias("comp"))
                   .join(classes.select("rep", "key", "size", "grams"), "rep"), "candidates")
    groups = cand.groupBy("comp").agg(F.greatest(
        F.ceil(F.sum("grams") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks"))
    members = cand.join(groups, "comp").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    sets = (slim.join(members.withColumnRenamed("rep", "id").drop("grams").hint("merge"), "id")
            .select("id", "text", "key", "comp", "size", "blocks", "block")
            .mapInArrow(_blocks(n), "comp long, bi int, bj int, block int, id long, size long, set binary"))
    found = durable(sets.repartition("comp", "bi", "bj").sortWithinPartitions("comp", "bi", "bj")
                    .mapInArrow(_verify(exact), "id long, links long, root long"), "links")
    links = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = (classes.select("key", "rep", "size").join(links, "rep", "left")
                 .join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left"))
    return (sigs.select("id", "key").join(per_class, "key", "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("class_id"),
                    F.when(F.col("id").isNull(), F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.coalesce("size", F.lit(1)) - 1)
                    .cast("long").alias("n_links"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))


ORACLE = {"op1_ngram_jaccard": r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 9 * c >= 4 * (s.n + t.n)),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
same AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN doc_id ELSE min(doc_id) OVER (PARTITION BY array_to_string(w, ' ')) END AS class_id FROM words)
SELECT d.doc_id, class_id, (SELECT count(*) FROM links l WHERE l.a = d.doc_id) AS n_links, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp USING (doc_id) JOIN same USING (doc_id)"""}
