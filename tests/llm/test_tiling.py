import random

from lakeloom.llm import tiling
from lakeloom.llm.tiling import greedy_tiles

from .cases import ODD, frame

ITEM = "the quick brown fox jumps over the lazy dog. Then nine old men walked down to a green river and sang there."


def brute_tiles(item, doc, shortest):
    """All matches by comparison, the longest marked first, until none is left."""
    free_i, free_d, covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k] and free_i[i + k] and free_d[d + k]:
                    k += 1
                best = max(best, (k, -i, -d))
        k, i, d = best[0], -best[1], -best[2]
        if k < shortest:
            return covered
        covered += k
        free_i[i:i + k] = [False] * k
        free_d[d:d + k] = [False] * k


def test_tiles_are_maximal_and_apart():
    rng = random.Random(4)
    for _ in range(80):
        item, doc = ([rng.randrange(4) for _ in range(rng.randrange(5, 25))] for _ in range(2))
        tiles = greedy_tiles(item, doc, 3)
        assert all(item[i:i + k] == doc[d:d + k] and k >= 3 for i, d, k in tiles)
        for side in (0, 1):
            cells = [t[side] + k for t in tiles for k in range(t[2])]
            assert len(cells) == len(set(cells))
        longest = max((t[2] for t in tiles), default=0)
        best = brute_tiles(item, doc, 3)
        assert (longest == 0) == (best == 0) and abs(sum(t[2] for t in tiles) - best) <= 4
        distinct_item, distinct_doc = rng.sample(range(30), 15), rng.sample(range(30), 20)
        assert sum(t[2] for t in greedy_tiles(distinct_item, distinct_doc, 2)) == brute_tiles(distinct_item, distinct_doc, 2)


def test_rest_of_a_clashing_match_is_tiled():
    s = [[f"s{k}{j}" for j in range(5)] for k in range(3)]
    t = [["the", *(f"t{k}{j}" for j in range(6))] for k in range(3)]
    codes = {w: n for n, w in enumerate(w for part in s + t for w in part)}
    item, doc = ([codes[w] for part in order for w in part]
                 for order in ((s[0], t[0], s[1], t[1], s[2], t[2]), (s[0], t[1], s[1], t[2], s[2], t[0])))
    assert sum(k for _, _, k in greedy_tiles(item, doc, 5)) == brute_tiles(item, doc, 5) == 36


def pairs(spark, rows, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return sorted((r.doc_id, r.item_id) for r in tiling.decontaminate(frame(spark, rows), benchmark, **options).collect())


def test_passages_are_found(spark):
    half, rest = ITEM.split(". ")
    filler = " ".join(f"f{k}" for k in range(300))
    rows = [(1, f"{filler} {ITEM} {filler}"), (2, f"{rest} {filler} {half}"), (3, ITEM.upper().replace(" ", "\n")), (4, f"{filler} {' '.join(half.split()[:6])}"),
            (5, filler), (6, " ".join(reversed(ITEM.split()))), (7, f"{half}, and {rest}")]
    assert pairs(spark, rows, [(1, ITEM), (2, "short item"), (3, None), (4, ""), (None, ITEM)]) == [(1, 1), (2, 1), (3, 1), (7, 1)]


def test_short_items_and_rounds(spark, monkeypatch):
    monkeypatch.setattr(tiling, "ROUND_WORDS", 10)
    items = [(k, f"alpha{k} beta{k} gamma{k} delta{k} eps{k} zeta{k}") for k in range(12)] + [(50, "tiny text")]
    rows = [(k, f"x y {t} z") for k, t in items]
    assert pairs(spark, rows, items) == [(k, k) for k, _ in items]


def test_odd_rows(spark):
    assert pairs(spark, ODD, [(1, ITEM)]) == []
    assert pairs(spark, [], [(1, ITEM)]) == [] and pairs(spark, [(1, ITEM)], []) == []
    assert pairs(spark, [(5, ITEM), (5, ITEM)], [(1, ITEM), (1, ITEM)]) == [(5, 1), (5, 1)]
