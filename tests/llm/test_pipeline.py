import corpus_pipeline
from lakeloom.llm import gam, jaccard, pieces, repeats, tiling
from lakeloom.llm.common import table

from .cases import ODD, frame, words

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_follow_their_operators(spark):
    docs = table(spark, SF, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "sentencepiece_encoding"]
    held = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in held.collect()]
        columns = held.columns
        now = stage(spark, held, SF)
        after = [tuple(r) for r in now.collect()]
        if name == "quality_classifier":
            scores = {r.doc_id: r.score for r in gam.score_quality(held, gam.quality_model(held, table(spark, SF, "labels"))).collect()}
            want = [r for r in before if scores[r[0]] >= 0.7]
        elif name == "ngram_jaccard_join":
            kept = {r.doc_id for r in jaccard.ngram_jaccard_join(held).collect() if r.kept}
            want = [r for r in before if r[0] in kept]
        elif name == "suffix_array_dedup":
            cut = {r.doc_id: r for r in repeats.remove_repeats(held, length=corpus_pipeline.PASSAGE).collect()}
            want = [(r[0], cut[r[0]].kept_text, *r[2:4], len(cut[r[0]].kept_text)) if cut[r[0]].n_removed else r for r in before]
        elif name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            leaks = {r.doc_id for r in tiling.decontaminate(held, table(spark, SF, "benchmark")).collect()}
            assert {i for i, t, *_ in before if any(x in t for _, x in items)} <= leaks
            want = [r for r in before if r[0] not in leaks]
        else:
            want = [tuple(r) for r in pieces.sample_pieces(held).collect()]
            assert all(r.lossless for r in now.collect()) and len(after) == len(before)
        assert sorted(after, key=str) == sorted(want, key=str) and len(after) > 0
        if name != names[-1]:
            assert now.columns == columns and now.schema == held.schema
            held = spark.createDataFrame(after, held.schema)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "ids", "n_ids", "n_bytes", "lossless"] and 0 < got.count() < table(spark, SF, "documents").count()


def test_odd_rows_pass_every_stage(spark):
    docs = frame(spark, [*ODD, (20, words(0, 300)), (21, words(100, 300))])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert rows_of(out) is not None
        assert stage(spark, docs.limit(0), SF).collect() == []
    deduped = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in deduped.collect()) == sorted(["1", "2", "3", "4", "5", "7", "8", "9", "20", "21", "None", "None"])
    assert deduped.columns == docs.columns
    cut = {r.doc_id: r for r in corpus_pipeline.repeated_strings(spark, docs, SF).collect()}
    assert cut[20].text == words(0, 100) + " " and cut[20].n_chars == len(cut[20].text) and cut[1].text is None


def brute_cut(texts, length):
    """Each text without what a string of ``length`` bytes covers that starts twice in all texts."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for k, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i:i + length], []).append((k, i))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i:i + length] = b"\x01" * length
    return [bytes(x for x, g in zip(b, cut) if not g).decode("utf-8", "ignore") for b, cut in zip(raw, gone)]


def test_passages_of_fifty_words_go(spark):
    """The stage against brute force: passages of 51 and of 30 short words, shared by clean texts, and a text of its own."""
    long, short = " ".join(f"pa{k:02d}" for k in range(51)), " ".join(f"sh{k:02d}" for k in range(30))
    texts = [f"{words(1000 * k, 40)} {long if k < 3 else short} {words(1000 * k + 500, 40)}" for k in range(6)] + [words(9000, 200), None, "", "é" * 300]
    docs = frame(spark, list(enumerate(texts)))
    got = {r.doc_id: r.text for r in corpus_pipeline.repeated_strings(spark, docs, SF).collect()}
    want = brute_cut(texts, corpus_pipeline.PASSAGE)
    assert [got[k] or "" for k in range(len(texts))] == want
    assert all("pa10" not in want[k] and words(1000 * k, 39) in want[k] for k in range(3)) and want[3:7] == texts[3:7]


def test_rows_of_one_id_with_other_texts_stay(spark):
    docs = frame(spark, [(1, words(0, 50)), (1, words(100, 50)), (2, words(200, 50)), (2, words(200, 50))])
    got = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert sorted((r.doc_id, r.text[:5]) for r in got.collect()) == [(1, "w0 w1"), (1, "w100 "), (2, "w200 ")]
