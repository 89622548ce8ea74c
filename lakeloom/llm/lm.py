"""Language-model scores of texts, beside an additive-smoothed unigram base."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.attention import WINDOW, Adam, Attention, Vocabulary, Windows
from lakeloom.llm.common import SPACE, chunks, distinct, durable, grouped, row_counts, spans, table, text_of, word_hashes
from lakeloom.llm.gam import fold
from lakeloom.llm.packing import UnitIds, read_ranks
from lakeloom.llm.pieces import gather

VOCABULARY = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "byte_bpe_multi_50k.tiktoken")
#: Documents to a bucket of words.
BUCKET_DOCS = 6000
#: The network reads all training texts once, dealt by hash into SHARE parts and over ROUNDS rounds that grow; windows and size of a step.
ROUNDS, SHARE, BATCH, RATE = 3, 64, 128, 0.01
#: Numbers of the network that are averaged together, and what one is multiplied by to be added as a whole number.
PIECE, SCALE = 512, 1 << 24
#: Bytes of text that a task works on at once, and that it spells at once.
CHUNK, SPELLED_AT_ONCE = 3 << 19, 3 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[SPACE] = 32


def spaced_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts, A-Z in lower case, each after one space: bytes, starts (of the space), ends, words in each text."""
    body = np.take(_LOWER, np.insert(data, offsets[:-1], 32))
    starts, ends = spans(body, offsets[:0])
    return body, starts - 1, ends, row_counts(starts, offsets + np.arange(len(offsets)))


_held: list = []


def held_units(ranks) -> UnitIds:
    """The ids of words, kept by a worker from task to task, so that it spells a word once; ``UnitIds`` bounds how many it remembers."""
    if not _held or _held[0] != ranks.value:
        _held[:] = [ranks.value, UnitIds(ranks.value)]
    return _held[1]


#: Texts in ids: the bytes of the text, its ids and the end token in two bytes each, how many each word has in one byte each (``LONG``: more follow).
_SPELLED = "id long, key long, train boolean, n_bytes long, ids binary, sizes binary"
LONG = 255
_PASSED = "ids array<long>, keys array<long>, words array<long>, token int, n long"
_COUNTED = f"kind int, bucket int, chunk long, codes binary, counts binary, lasts binary, held binary, pair_row binary, pair_many binary, {_PASSED}"
_SUMMED = f"kind int, chunk long, sums binary, known binary, types long, {_PASSED}"


def _batch(schema: str, rows: int, **columns) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [f.strip().split(" ") for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kinds[kind]) if name in columns else pa.nulls(rows, kinds[kind]) for name, kind in fields],
                                      [name for name, _ in fields])


def _words(units: UnitIds, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words of texts laid end to end, ids in each word, words in each text; the end token is the last word of each."""
    body, starts, ends, many = spaced_words(data, offsets)
    stop = np.cumsum(many)
    if not len(starts):
        return np.full(len(many), end, np.int32), np.ones(len(many), np.int64), many + 1
    _, unit, at = units.units(body, starts, ends)
    which = np.insert(at[unit], stop, len(units.size))
    size = np.append(units.size, 1)[which]
    return gather(np.append(units.flat, np.int32(end)), np.append(units.start, len(units.flat))[which], size), size, many + 1


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest takes."""
    return values.astype(np.min_scalar_type(values.max(initial=0))).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of ``_narrow``."""
    return np.frombuffer(data, f"u{len(data) // max(n, 1) or 1}")


def _per_text(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of sizes over so many at a time."""
    return np.diff(np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))])


def _binary(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column of so many values in each row."""
    offsets = np.append(0, np.cumsum(counts * values.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])


def _values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column laid end to end, and where each row ends."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data.view(kind), (offsets[1:] - offsets[0]) // np.dtype(kind).itemsize


def _spell(ranks, end: int):
    """Each text in ids, so that it is spelled once for all that follows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = held_units(ranks)
        for batch in batches:
            for first, offsets, data in chunks(batch.column("text"), SPELLED_AT_ONCE):
                ids, size, many = _words(units, data, offsets, end)
                entries = size // LONG + 1
                sizes = np.full(int(entries.sum()), LONG, np.uint8)
                sizes[np.cumsum(entries) - 1] = size % LONG
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(many)) for c in ("id", "key", "train")), pa.array(np.diff(offsets)),
                                                  _binary(ids.astype(np.uint16), _per_text(size, many)), _binary(sizes, _per_text(entries, many))],
                                                 ["id", "key", "train", "n_bytes", "ids", "sizes"])
    return run


def _spelled(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of a batch of ``CHUNK`` bytes of text: first row, ids of its words and ends, ids in each, words and end in each text."""
    upto = np.append(0, np.cumsum(batch.column("n_bytes").to_numpy()))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + CHUNK, "right")) - 1)
        ids, _ = _values(batch.column("ids").slice(at, to - at), np.uint16)
        sizes, ends = _values(batch.column("sizes").slice(at, to - at), np.uint8)
        last = np.flatnonzero(sizes < LONG)
        yield at, ids.astype(np.int32), np.diff(np.cumsum(sizes, dtype=np.int64)[last], prepend=0), np.diff(np.searchsorted(last, ends), prepend=0)
        at = to


def _count(buckets: int, end: int):
    """Per part of the corpus: its words by bucket, with counts in training texts and the texts that hold them.

    Different words differ in their ids, so words are told apart by these.
    Kinds of rows: 0 words of one bucket, 1 the part's documents, 2 subword
    counts of training texts. A part is named by its task and its number there.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = (context.partitionId() if context else 0) << 32
        subwords = np.zeros(end + 1, np.int64)
        for batch in batches:
            learns = batch.column("train").to_numpy(zero_copy_only=False).astype(bool)
            for first, ids, size, many in _spelled(batch):
                rows = len(many)
                train = learns[first:first + rows]
                subwords[end] += train.sum()
                word = np.ones(len(size), bool)
                word[np.cumsum(many) - 1] = False
                stop, size, many = np.cumsum(size)[word], size[word], many - 1
                if len(size):
                    codes, one, unit = distinct(word_hashes(ids.astype(np.uint16).view(np.uint8), 2 * (stop - size), 2 * stop))
                    row = np.repeat(np.arange(rows), many)
                    counts = np.bincount(unit[train[row]], minlength=len(codes))
                    last = ids[stop[one] - 1].astype(np.uint16)
                    subwords += np.bincount(gather(ids, (stop - size)[one], size[one]), np.repeat(counts, size[one]), end + 1).astype(np.int64)
                    pair, tf = np.unique(unit * np.int64(rows) + row, return_counts=True)
                    word, in_row = pair // rows, pair % rows
                    held = np.bincount(word, minlength=len(codes))
                    bucket = ((codes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
                    to = np.append(cut[1:], len(codes))
                    lo, hi = np.searchsorted(word, cut), np.searchsorted(word, to)
                    yield _batch(_COUNTED, len(cut), kind=[0] * len(cut), bucket=bucket[cut].astype(np.int32), chunk=[part] * len(cut),
                                 codes=[codes[a:b].tobytes() for a, b in zip(cut, to, strict=True)],
                                 counts=[_narrow(counts[a:b]) for a, b in zip(cut, to, strict=True)],
                                 lasts=[last[a:b].tobytes() for a, b in zip(cut, to, strict=True)],
                                 held=[_narrow(held[a:b]) for a, b in zip(cut, to, strict=True)],
                                 pair_row=[_narrow(in_row[a:b]) for a, b in zip(lo, hi, strict=True)],
                                 pair_many=[_narrow(tf[a:b]) for a, b in zip(lo, hi, strict=True)])
                yield _batch(_COUNTED, 1, kind=[1], bucket=[part % buckets], chunk=[part], words=[many.tolist()],
                             ids=[batch.column("id").slice(first, rows).to_pylist()], keys=[batch.column("key").slice(first, rows).to_pylist()])
                part += 1
        seen = np.flatnonzero(subwords)
        yield _batch(_COUNTED, len(seen), kind=[2] * len(seen), bucket=seen % buckets, token=seen, n=subwords[seen])
    return run


def _score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each bucket's words over all parts; then for each part the sums that its texts get from them."""
    for group in grouped(batches, ["bucket"]):
        kinds = group["kind"].to_numpy()
        rest = group.filter(pa.array(kinds > 0))
        if rest.num_rows:
            yield _batch(_SUMMED, rest.num_rows, **{c: rest[c].to_pylist() for c in ("kind", "chunk", "ids", "keys", "words", "token", "n")})
        parts = group.filter(pa.array(kinds == 0))
        if not parts.num_rows:
            continue
        read = lambda name, kind, parts=parts: [np.frombuffer(x, kind) for x in parts[name].to_pylist()]
        codes = read("codes", np.uint64)
        wide = lambda name, many, parts=parts: [_wide(x, n) for x, n in zip(parts[name].to_pylist(), many, strict=True)]
        sizes = [len(c) for c in codes]
        counts, held = wide("counts", sizes), wide("held", sizes)
        pairs = [int(h.sum(dtype=np.int64)) for h in held]
        all_codes, place = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(place.ravel(), np.concatenate(counts), len(all_codes))
        value = np.log10(total + 0.5)
        place = np.split(place.ravel(), np.cumsum(sizes)[:-1])
        sums, known = [], []
        for at, in_rows, row, many in zip(place, held, wide("pair_row", pairs), wide("pair_many", pairs), strict=True):
            which = np.repeat(at, in_rows)
            sums.append(np.bincount(row, many * value[which]).tobytes())
            known.append(np.bincount(row, many * (total[which] > 0)).astype(np.uint32).tobytes())
        yield _batch(_SUMMED, len(sums), kind=[0] * len(sums), chunk=parts["chunk"].to_pylist(), sums=sums, known=known)
        last = np.zeros(len(all_codes), np.int64)
        for at, own in zip(place, read("lasts", np.uint16), strict=True):
            last[at] = own
        words, types = np.bincount(last, total), np.bincount(last, total > 0)
        seen = np.flatnonzero(types)
        yield _batch(_SUMMED, len(seen), kind=[3] * len(seen), token=seen, n=words[seen].astype(np.int64), types=types[seen].astype(np.int64))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of each text over all buckets."""
    for group in grouped(batches, ["chunk"]):
        kinds = group["kind"].to_pylist()
        info = kinds.index(1)
        words = np.array(group["words"][info].as_py(), np.int64)
        sums, known = np.zeros(len(words)), np.zeros(len(words), np.int64)
        for kind, s, k in zip(kinds, group["sums"].to_pylist(), group["known"].to_pylist(), strict=True):
            if kind == 0:
                s, k = np.frombuffer(s), np.frombuffer(k, np.uint32)
                sums[:len(s)] += s
                known[:len(k)] += k
        yield pa.RecordBatch.from_arrays([pa.array(group["ids"][info].as_py(), pa.int64()), pa.array(group["keys"][info].as_py(), pa.int64()),
                                          pa.array(words), pa.array(known), pa.array(sums)], ["id", "key", "words", "known", "sums"])


def _goals(ids: np.ndarray, size: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of texts, each with the end token, laid end to end; the last id of each word where the word starts, else -1; ids in each text."""
    goals = np.full(len(ids), -1)
    stop = np.cumsum(size)
    goals[stop - size] = ids[stop - 1]
    return ids, goals, np.diff(stop[np.cumsum(many) - 1], prepend=0)


def _sequences(units: UnitIds, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same straight from texts."""
    return _goals(*_words(units, data, offsets, end))


def start_attention(vocabulary: Vocabulary) -> Attention:
    """A network that knows how frequent the classes are in all training texts, and nothing of contexts."""
    model = Attention(vocabulary.n_inputs, len(vocabulary.mass))
    model.p["bias"][:] = np.log((vocabulary.mass + 0.5) / (vocabulary.mass + 0.5).sum())
    return model


def refine(docs: DataFrame, ranks, vocabulary: Vocabulary, model: Attention, end: int, rounds: int = ROUNDS, share: int = SHARE) -> Attention:
    """Train on all training texts, each in one round, so that what the network has seen grows with the corpus.

    Texts are dealt by hash into ``share`` parts. The first round takes few of
    them, as copies of an untrained network soon differ; each further one takes
    more, with smaller steps, and the last one takes all that are left. In a
    round every partition trains a copy on the windows of its part of the
    texts, and changes are averaged, each by its windows. They are added as
    whole numbers, so the order of the parts does not matter. A task holds one
    copy and the text it reads at once; the driver, one sum. ``docs`` has its
    texts in ids, as ``_spell`` gives them, or is spelled in each round.
    """
    spark = docs.sparkSession
    if "ids" not in docs.columns:
        docs = docs.mapInArrow(_spell(ranks, end), _SPELLED)
    sizes = np.cumsum([v.size for v in model.p.values()])
    cuts = [0, *(round(share ** ((k + 1) / rounds)) for k in range(rounds))]
    for k in range(rounds):
        sent = spark.sparkContext.broadcast((vocabulary, model.p))
        rate = RATE * (1 - k / rounds)

        def train(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            vocabulary, params = sent.value
            net, seen = Attention(vocabulary.n_inputs, len(vocabulary.mass)), 0
            net.p = {name: v.copy() for name, v in params.items()}
            adam, rng = Adam(net.p), np.random.Generator(np.random.PCG64(11))
            for batch in batches:
                for _, *spelled in _spelled(batch):
                    windows = Windows(vocabulary, net.start, *_goals(*spelled), stride=WINDOW)
                    order = rng.permutation(len(windows.row))
                    step = int(np.clip(len(order) // 50, 16, BATCH))
                    for a in range(0, len(order), step):
                        before, wanted, classes = windows.cut(order[a:a + step])
                        adam.step(net.gradients(before, classes, wanted)[1], rate)
                    seen += len(order)
            if seen:
                change = np.concatenate([(net.p[name] - v).ravel() for name, v in params.items()]).astype(np.float64)
                whole = np.rint(change * seen * SCALE).astype(np.int64)
                cut = range(0, len(whole), PIECE)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cut)), pa.int32()), pa.array([seen] * len(cut), pa.int64()),
                                                  pa.array([whole[a:a + PIECE].tobytes() for a in cut], pa.binary())], ["piece", "seen", "change"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list] = {}
            for batch in batches:
                for piece, seen, change in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own = held.setdefault(piece, [0, np.zeros(len(change) // 8, np.int64)])
                    own[0] += seen
                    own[1] += np.frombuffer(change, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x[0] for x in held.values()], pa.int64()),
                                              pa.array([x[1].tobytes() for x in held.values()], pa.binary())], ["piece", "seen", "change"])

        shape = "piece int, seen long, change binary"
        dealt = F.pmod(F.xxhash64("id", "key", F.lit("round")), F.lit(share))
        own = docs.filter("train").filter((dealt >= cuts[k]) & (dealt < cuts[k + 1])).select("n_bytes", "ids", "sizes")
        found = own.mapInArrow(train, shape).repartition("piece").mapInArrow(add, shape).toArrow().sort_by("piece")
        if not found.num_rows:
            continue
        change = np.concatenate([np.frombuffer(x, np.int64) for x in found["change"].to_pylist()]) / (float(found["seen"][0].as_py()) * SCALE)
        for (name, v), part in zip(list(model.p.items()), np.split(change, sizes[:-1]), strict=True):
            model.p[name] = (v + part.reshape(v.shape)).astype(np.float32)
    return model


def _score(model):
    made: list = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            vocabulary, params = model.value
            net = Attention(vocabulary.n_inputs, len(vocabulary.mass))
            net.p = params
            made.extend([vocabulary, net])
        vocabulary, net = made
        for batch in batches:
            for first, ids, size, many in _spelled(batch):
                _, goals, count = _goals(ids, size, many)
                within = np.bincount(np.repeat(np.arange(len(many)), many), np.take(vocabulary.norm, ids[np.cumsum(size) - 1]), len(many))
                score = (net.score(vocabulary, ids, goals, count) - within) / np.log(10)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, len(count)), batch.column("key").slice(first, len(count)),
                                                  pa.array(count), pa.array(score)], ["id", "key", "n_subwords", "score"])
    return run


def language_model_scores(docs: DataFrame, train=None, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                          end: int = 50256) -> DataFrame:
    """Log10 probabilities of every text under a causal attention model and under a unigram base.

    ``train`` is a condition on ``docs``: the rows to learn from (default: all).
    Columns: id, ``n_tokens`` (words and one end), ``n_known`` (tokens seen in
    training), ``train_tokens``, ``base_score``, ``score``, ``n_subwords``.

    Base: words and texts are cut into buckets by word hash, pre-counted per
    part of the corpus; each bucket's counts over all training texts give every
    text its share of the sum, so no count table is collected or broadcast.

    Model: the words, A-Z in lower case, are spelled in subword ids, each after
    a space, with an end token; ids are written once, and all steps read them. Where a word starts, the network predicts its
    class from the ids before it; a class is the words with the same last id,
    or, for rarer last ids, of a group of them. Within its class a word has the
    share (c + 0.5) / (words + 0.5 * (different words + 1)) of all training
    texts, so unseen words are one further word of their class, as they are one
    word in the base. The logarithms of c are those that the base sums up. The
    network is trained on all training texts, each read once (``refine``);
    every text is scored whole, in overlapping windows of 32 ids that score
    each word once.

    Defined results: null and empty texts are the end token alone. Rows without
    an id are scored too. Rows that repeat an id with the same text repeat the
    scores. White space other than a word's end is not scored. An empty
    table gives an empty result. Only the columns named and those of ``train``
    are read.
    """
    spark = docs.sparkSession
    table_of = read_ranks(vocabulary)
    if max(end, *table_of.values()) >= 1 << 16:
        raise ValueError("ids are kept in two bytes: the vocabulary may have 65536")
    ranks = spark.sparkContext.broadcast(table_of)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"),
                       F.coalesce(F.lit(True) if train is None else train, F.lit(False)).alias("train")).withColumn("key", F.xxhash64("text"))
    spelled = durable(slim.mapInArrow(_spell(ranks, end), _SPELLED), "spelled")
    buckets = max(16, -(-spelled.count() // BUCKET_DOCS))
    counted = spelled.mapInArrow(_count(buckets, end), _COUNTED)
    summed = durable(counted.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_score_words, _SUMMED), "summed")
    uses, words, types = np.zeros((3, end + 1))
    seen = (summed.filter("kind IN (2, 3)").groupBy("kind", "token").agg(F.sum("n").alias("n"), F.sum("types").alias("types")).fillna(0).toArrow())
    kind, token = seen["kind"].to_numpy(), seen["token"].to_numpy()
    uses[token[kind == 2]] = seen["n"].to_numpy()[kind == 2]
    words[token[kind == 3]], types[token[kind == 3]] = (seen[c].to_numpy()[kind == 3] for c in ("n", "types"))
    ends = int(uses[end])
    words[end], types[end] = ends, ends > 0
    n, v = int(words.sum()), int(types.sum())
    last = float(np.log10(ends + 0.5))
    base = (summed.filter("kind < 2").repartition("chunk").sortWithinPartitions("chunk")
            .mapInArrow(_gather, "id long, key long, words long, known long, sums double").dropDuplicates(["id", "key"]))
    vocabulary = Vocabulary.of(uses, words, types)
    net = refine(spelled, ranks, vocabulary, start_attention(vocabulary), end)
    scored = spelled.select("id", "key", "n_bytes", "ids", "sizes").mapInArrow(_score(spark.sparkContext.broadcast((vocabulary, net.p))),
                                                                               "id long, key long, n_subwords long, score double")
    scored = scored.alias("s").join(base.alias("b"), F.col("s.id").eqNullSafe(F.col("b.id")) & (F.col("s.key") == F.col("b.key")))
    tokens = F.col("words") + 1
    return scored.select(
        F.col("s.id").alias(id_col), tokens.alias("n_tokens"), (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("sums") + last - tokens * float(np.log10(n + 0.5 * (v + 1)))).alias("base_score"),
        (F.col("score") + F.col("sums") + last).alias("score"), "n_subwords")


def op10_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = language_model_scores(docs, fold("doc_id", 5) != 1)
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_subwords")
