import random

from cuenca.llm import decontaminate as D

ITEM = "Alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda mu nu xi omicron pi. Rho sigma tau upsilon phi chi psi omega."


def plain_tile(doc, item, least):
    """Textbook greedy string tiling over all positions."""
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), 0
    least = max(1, min(least, len(item)))
    while True:
        best, at = least - 1, []
        for i in range(len(item)):
            for d in range(len(doc)):
                k = 0
                while i + k < len(item) and d + k < len(doc) and item[i + k] == doc[d + k] and free_i[i + k] and free_d[d + k]:
                    k += 1
                if k > best:
                    best, at = k, [(i, d)]
                elif k == best and k >= least:
                    at.append((i, d))
        if best < least or not at:
            return tiles
        for i, d in at:
            if all(free_i[i:i + best]) and all(free_d[d:d + best]):
                free_i[i:i + best] = free_d[d:d + best] = [False] * best
                tiles += best


def leaks(spark, docs, items, **kw):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.leaks(d, b, **kw).collect()}


def test_copies_reordered_and_clean(spark):
    parts = [s.strip() for s in ITEM.split(".") if s.strip()]
    docs = ["x y z " + ITEM + " more words", "; ".join(reversed(parts)).upper() + " tail", parts[0] + " and nothing else",
            "quite other words stand here, and no passage", None, "", "alpha beta gamma"]
    got = leaks(spark, docs, [ITEM, "short one", None, "", "alpha beta gamma"])
    assert {k for k in got if k[1] == 0} == {(0, 0), (1, 0)}
    assert got[0, 0].coverage == 1.0 and got[1, 0].coverage == 1.0 and got[1, 0].n_tiles >= 3
    assert {k for k in got if k[1] == 4} == {(0, 4), (1, 4), (2, 4), (6, 4)}     # an item shorter than a seed


def test_tiles_equal_textbook_tiling():
    rng = random.Random(5)
    h = D._Hash()
    for _ in range(150):
        doc = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(0, 25))]
        item = [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 15))]
        got = D.tile(h.of(doc), h.of(item), 3)
        assert sum(t[2] for t in got) == plain_tile(doc, item, 3)
        used_i, used_d = set(), set()
        for i, d, k in got:
            assert item[i:i + k] == doc[d:d + k]
            assert not used_i & set(range(i, i + k)) and not used_d & set(range(d, d + k))
            used_i |= set(range(i, i + k))
            used_d |= set(range(d, d + k))


def test_blocks_of_the_benchmark_change_nothing(spark):
    items = [ITEM, ITEM[::-1], "one two three four five six seven", ITEM]
    docs = [ITEM, items[2] + " " + ITEM, "none of it"]
    whole = leaks(spark, docs, items)
    small = leaks(spark, docs, items, block_chars=10)
    assert set(whole) == set(small) == {(0, 0), (0, 3), (1, 0), (1, 2), (1, 3)}


def test_clean_keeps_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, ITEM, "k"), (2, "fine text", None), (2, "fine text", None)], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    out = D.clean(docs, bench)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [2, 2]
    assert D.clean(docs, bench.limit(0)).count() == 3 and D.leaks(docs, bench.limit(0)).count() == 0
    assert D.leaks(docs.limit(0), bench).count() == 0


def test_repetitive_texts_take_no_product_of_positions():
    import time
    h = D._Hash()
    t = time.time()
    for doc, item, covered in (([b"a"] * 20_000, [b"a"] * 20_000, 20_000), ([b"a"] * 8000, [b"a"] * 500, 500),
                               (([b"a"] * 5 + [b"x"]) * 3000, [b"a"] * 500, 500), ([b"a", b"b"] * 10_000, [b"b", b"a"] * 300, 600)):
        assert sum(x[2] for x in D.tile(h.of(doc), h.of(item), 5)) == covered
    assert time.time() - t < 60


def test_equal_hashes_of_other_tokens_are_no_match(monkeypatch):
    real = D._Hash.__missing__
    monkeypatch.setattr(D._Hash, "__missing__", lambda self, w: real(self, b"w" if w.startswith(b"w") else w))
    find = D._Finder([(1, b"w1 w2 w3 w4 w5 w6 w7 w8")], 5, 0.6)
    assert find(b"w9 w9 w9 w9 w9 w9 w9 w9") == [] and len(find(b"x w1 w2 w3 w4 w5 w6 w7 w8 y")) == 1
