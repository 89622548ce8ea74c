"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import components, durable, grouped, link_rows, table, tie_up

#: Vectors that rotations are learned from at most; vectors in a verifying block; rows of a bucket in one task.
SAMPLE_ROWS, BLOCK, BUCKET_ROWS = 20_000, 1024, 50_000


def learn_rotation(x: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """Iterative quantisation: alternate the nearest binary codes and the orthogonal map that fits them best."""
    rng = np.random.Generator(np.random.PCG64(seed))
    rotation, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
    for _ in range(rounds if len(x) else 0):
        codes = np.where(x @ rotation >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(codes.T @ x)
        rotation = (u @ vt).T
    return rotation


def choose_tables(rows: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a table's key, so that unrelated vectors seldom meet, and tables, so that pairs at the threshold do.

    A bit of two vectors at this cosine agrees with probability 1 - angle / pi.
    """
    bits = min(max(math.ceil(math.log2(max(rows, 1) / 8 + 1)), 8), 30)
    agree = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return bits, 1 if agree >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


#: Shares of the common component that may be taken out before signs are.
SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)


def widest_flip(threshold: float, shortest: float) -> float:
    """How often a bit differs at most, for unit vectors at the threshold that lie ``shortest`` or more from the centre.

    Moving the centre leaves their distance as it is and changes the angle
    under which it is seen; it is widest when both are nearest to the centre.
    """
    half = math.sqrt(max(0.0, (1 - min(threshold, 1.0)) / 2))
    return 1.0 if half >= shortest else 2 * math.asin(half / shortest) / math.pi


def choose_share(rows: int, threshold: float, recall: float, shortest: list[float], unrelated: list[float]) -> int:
    """Which of ``SHARES`` takes the least work: rows in all tables, what they meet there, and whether unrelated ones are tied.

    ``shortest`` holds the least distance of a vector from each centre, ``unrelated`` how often a bit of two of the sample differs.
    """
    def work(k: int) -> float:
        flip = widest_flip(threshold, shortest[k])
        if flip >= 0.45:  # the vectors themselves, the first choice, always allow for the recall
            return math.inf if k else 1e300
        bits, tables = choose_tables(rows, math.cos(math.pi * flip), recall)
        met = rows * (1 - unrelated[k]) ** bits
        return tables * (1 + met) * (1 + (met if 1.5 * flip + 0.1 >= unrelated[k] else 0))

    return min(range(len(SHARES)), key=lambda k: (work(k), k))


def _units(lists: pa.Array, d: int) -> np.ndarray:
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _mean_angle(x: np.ndarray) -> float:
    """Of pairs of different vectors."""
    if len(x) < 2:
        return math.pi / 2
    x = x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)
    return float(np.arccos(np.clip(x @ x.T, -1, 1))[np.triu_indices(len(x), 1)].mean())


def _codes(spark: SparkSession, models: dict[int, tuple[np.ndarray, np.ndarray]], bits: int, tables: int):
    """A row for each vector and table: the table's key and the whole code."""
    sent = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for d in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == d))
                mean, rotations = sent.value[d]
                sign = (_units(part.column(3), d) - mean) @ rotations >= 0
                code = np.packbits(sign, axis=1)
                raw = [c.tobytes() for c in code]
                weights = 1 << np.arange(bits, dtype=np.int64)
                for t in range(tables):
                    key = sign[:, t * bits:(t + 1) * bits] @ weights
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), part.column(2), pa.array(np.full(len(key), t, np.int32)), pa.array(key), pa.array(raw, pa.binary())],
                        ["rep", "label", "dim", "tab", "key", "code"])
    return run


def _shortest(spark: SparkSession, centres: dict[int, np.ndarray]):
    """The least distance of a part's vectors from each centre of their dimension."""
    sent = spark.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims).tolist():
                x = _units(batch.filter(pa.array(dims == d)).column(1), d)
                far = np.array([np.sqrt(((x - c) ** 2).sum(1).min()) for c in sent.value[d]])
                least[d] = np.minimum(least.get(d, np.inf), far)
        rows = [(d, k, float(v)) for d, far in least.items() for k, v in enumerate(far)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.float64()))],
                                         ["dim", "share", "far"])
    return run


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(2, dtype=np.int32)


def _lead(cover: int, reach: int, split: bool):
    """Streams through buckets and ties each vector to leaders.

    A vector farther than ``cover`` from all leaders so far leads itself.
    Every vector is tied to each leader within ``reach`` + ``cover``; so two
    vectors within ``reach`` hang together through the leader that covers the
    earlier one. Only leaders are held. Rows of buckets in several parts give
    their leaders on, which are tied across parts within ``reach`` + 2 ``cover``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, ids, codes = None, [], None
        for batch in batches:
            out, led = [], []
            names = [c for c in ("label", "dim", "tab", "key", "part") if c in batch.schema.names]
            cols = [batch.column(c).to_numpy() for c in names]
            change = np.zeros(batch.num_rows, bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            rep = batch.column("rep").to_numpy()
            raw = batch.column("code").to_pylist()
            hot = batch.column("hot").to_pylist() if split else None
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                bucket = tuple(c[a] for c in cols)
                if bucket != last:
                    last, ids, codes = bucket, [], None
                if b - a == 1 and not ids and not (split and hot[a]):
                    first = np.frombuffer(raw[a] + bytes(-len(raw[a]) % 8), np.uint64)[None]
                    ids, codes = [int(rep[a])], first
                    continue
                for at in range(a, b, 512):
                    to = min(b, at + 512)
                    own = np.stack([np.frombuffer(r + bytes(-len(r) % 8), np.uint64) for r in raw[at:to]])
                    covered = np.zeros(to - at, bool)

                    def tie(leader: int, far: np.ndarray, at: int = at, covered: np.ndarray = covered) -> None:
                        covered |= far <= cover
                        near = np.flatnonzero(far <= reach + cover)
                        out.extend((int(rep[at + k]), leader) for k in near.tolist() if rep[at + k] != leader)

                    for k in range(0, len(ids), 256):
                        for leader, far in zip(ids[k:k + 256], _distance(codes[k:k + 256], own), strict=True):
                            tie(leader, far)
                    while not covered.all():
                        k = int(covered.argmin())
                        leader = int(rep[at + k])
                        ids.append(leader)
                        codes = own[k:k + 1] if codes is None else np.concatenate([codes, own[k:k + 1]])
                        if split and hot[at + k]:
                            led.append((leader, *bucket[:4], raw[at + k]))
                        tie(leader, _distance(own[k:k + 1], own)[0])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            rows = [(a, b, None, None, None, None, None, None) for a, b in out] + [(None, None, *x) for x in led]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                             ["a", "b", "rep", "label", "dim", "tab", "key", "code"])
    return run


_TIES = "a long, b long, rep long, label int, dim int, tab int, key long, code binary"


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in grouped(batches, ["comp", "label", "dim", "bi", "bj"]):
            ids, size, block = (group[c].to_numpy() for c in ("id", "size", "block"))
            x = _units(group["embedding"].combine_chunks(), group["dim"][0].as_py())
            near = np.triu(x @ x.T >= threshold, 1)
            if group["bi"][0].as_py() != group["bj"][0].as_py():
                near &= block[:, None] != block[None, :]
            i, j = np.nonzero(near)
            out += tie_up(ids, size, i, j)
            if len(out) > 20_000:
                yield link_rows(out)
                out = []
        yield link_rows(out)
    return run


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                           threshold: float = 0.98, recall: float = 0.99999, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Vectors of the same label whose cosine is ``threshold`` or more.

    Returns one row per input row: id, ``n_links`` (other rows linked
    directly), ``component_id`` (smallest id reachable) and ``kept``.

    1. Equal vectors of a label are one class.
    2. Rotations are learned by iterative quantisation on at most
       ``sample_rows`` classes, chosen by hash; as many from different starts
       as the tables need bits. Every class is coded and put into each table.
       Of the common component as much is taken out before as makes the least
       work; bits, tables and reach are those for the widest angle under which
       a pair at the threshold is then seen, from the least distance of any
       class from the centre.
    3. Vectors with equal keys in a table are tied to leaders by the Hamming
       distance of whole codes, which a stream through the bucket does while
       holding leaders only; very large buckets are dealt to several tasks.
       Ties are far wider than the threshold, and give groups of candidates.
    4. In each group all original vectors are compared in double precision, by
       products of bounded blocks.

    ``recall`` is that of the tables for a pair exactly at the threshold, so
    the expected loss is one such pair in 100,000; tests compare with brute force.

    Defined results: vectors that are null, zero or hold null or non-finite
    components, and rows without label or id, link with nothing (component: own
    id). Vectors of different lengths are not compared. Repeated rows link with
    each other. An empty table gives an empty result. Only the columns named
    are read.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    good = (F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("embedding", lambda x: x != 0))
    classes = durable(slim.filter(F.coalesce(good, F.lit(False))).groupBy("label", "embedding")
                      .agg(F.min("id").alias("rep"), F.count("*").alias("size"))
                      .withColumn("dim", F.size("embedding")), "classes")
    sizes = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    samples, centres, unrelated = {}, {}, {}
    for d in sorted(r.dim for r in classes.select("dim").distinct().toLocalIterator()):
        sample = classes.filter(F.col("dim") == d).orderBy(F.xxhash64("embedding"), "label").limit(sample_rows)
        x = samples[d] = _units(sample.select("embedding").toArrow()["embedding"].combine_chunks(), d)
        mean = x.mean(0) if len(x) > d else np.zeros(d)
        centres[d] = np.outer(SHARES, mean)
        unrelated[d] = [_mean_angle(x[:1000] - c) / math.pi for c in centres[d]]
    far: dict[int, list[float]] = {d: [1.0] * len(SHARES) for d in samples}
    for r in classes.select("dim", "embedding").mapInArrow(_shortest(spark, centres), "dim int, share int, far double").groupBy("dim", "share").agg(F.min("far").alias("far")).collect():
        far[r.dim][r.share] = r.far * (1 - 1e-9)
    share = {d: choose_share(sizes, threshold, recall, far[d], unrelated[d]) for d in samples}
    flip = max((widest_flip(threshold, far[d][k]) if k else math.acos(min(threshold, 1.0)) / math.pi for d, k in share.items()), default=0.0)
    bits, tables = choose_tables(sizes, math.cos(math.pi * flip), recall)
    models = {}
    widest = 1
    for d, x in samples.items():
        centre = centres[d][share[d]]
        turns = [learn_rotation(x - centre, seed) for seed in range(-(-bits * tables // d))]
        models[d] = (centre, np.concatenate(turns, 1))
        widest = max(widest, models[d][1].shape[1])
    reach = math.ceil(widest * flip + 6 * math.sqrt(widest * flip * (1 - flip)))
    cover = reach // 2
    coded = durable(classes.select("rep", "label", "dim", "embedding")
                    .mapInArrow(_codes(spark, models, bits, tables), "rep long, label int, dim int, tab int, key long, code binary"), "codes")
    bucket = ["label", "dim", "tab", "key"]
    counts = durable(coded.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    parts = F.ceil(F.col("n") / BUCKET_ROWS)
    dealt = coded.join(counts, bucket).select(*bucket, F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part"), (parts > 1).alias("hot"), "rep", "code")
    ties = durable(dealt.repartition(*bucket, "part").sortWithinPartitions(*bucket, "part", "rep")
                   .mapInArrow(_lead(cover, reach, True), _TIES), "ties")
    across = (ties.filter("code IS NOT NULL").repartition(*bucket).sortWithinPartitions(*bucket, "rep")
              .mapInArrow(_lead(0, reach + 2 * cover, False), _TIES))
    cand = components(ties.filter("a IS NOT NULL").select("a", "b").union(across.select("a", "b"))).withColumnsRenamed({"id": "rep", "component": "comp"})
    groups = cand.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = (classes.join(cand, "rep").join(groups, "comp")
               .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("comp", "label", "dim", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"),
                       "block", F.col("rep").alias("id"), "size", "embedding"))
    keys = ["comp", "label", "dim", "bi", "bj"]
    found = durable(members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_verify(threshold), "id long, links long, root long"), "links")
    links = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    comps = components(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
    per_class = classes.select("label", "embedding", "rep", "size").join(links, "rep", "left").join(comps, "rep", "left")
    return (slim.join(per_class, (slim.label == per_class.label) & (slim.embedding == per_class.embedding) & slim.id.isNotNull(), "left")
            .select(slim.id.alias(id_col),
                    F.coalesce(F.coalesce("links", F.lit(0)) + F.col("size") - 1, F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "rep", slim.id).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def op3_itq_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


ORACLE = {"op3_itq_near_duplicates": """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
good AS MATERIALIZED (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN comp USING (vec_id)"""}
