import random

import pytest

from cuenca.llm import ngram_join as N


def brute(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().split()
        k = min(5, len(w))
        sets[d] = frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else frozenset([("alone", d)])
    ids = sorted(sets)
    up, n = {d: d for d in ids}, dict.fromkeys(ids, 0)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                n[a] += 1
                n[b] += 1
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {(d, root(d), n[d]) for d in ids}


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(2000)]
    base = [rng.choice(vocab) for _ in range(200)]
    rows = []
    for _ in range(180):        # a large group of near copies: more than one block
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(200)] = rng.choice(vocab)
        rows.append(" ".join(w))
    rows += [" ".join(base)] * 40
    for _ in range(80):
        rows.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 40))))
    for k in range(40):
        w = rows[220 + 2 * k].split()
        if w:
            w[rng.randrange(len(w))] = "zz"
        rows.append(" ".join(w))
    return list(enumerate(rows + ["", None, "a b", "a b", "a"]))


def test_classes_and_links_equal_all_pairs(spark):
    rows = corpus()
    got = {(r.doc_id, r.class_id, r.n_links) for r in N.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_pruning_keeps_every_pair_at_the_threshold():
    from math import comb
    least = N.least_matches(0.8)
    for n, m in least.items():      # the chance that a pair at 0.8 is dropped at this step
        assert sum(comb(n, k) * 0.8 ** k * 0.2 ** (n - k) for k in range(m)) < 1e-5
        assert m > 0


def test_representatives_keep_one_of_each_group(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t in rows] + [(None, "x y", None, None)], "doc_id long, text string, member string, u int")
    out = N.representatives(docs)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, c, _ in brute(rows)}) and ids.count(None) == 1


def test_empty_table_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert N.groups(none).count() == 0
    same = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "a b c d e f")], "doc_id long, text string")
    assert {(r.doc_id, r.class_id, r.n_links) for r in N.groups(same).collect()} == {(1, 1, 3), (2, 1, 3)}


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 52)]])
def test_components(spark, edges):
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "u binary, v binary")
    got = {(r.member[0], r.root[0]) for r in N.components(df).collect()}
    up = {}
    for a, b in edges:
        for x in (a, b):
            up.setdefault(x, x)
    for _ in edges:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == set(up.items())


def _group(n, others, seed=5):
    """(member, sig) of ``n`` near copies, and of others that share one band with them and
    among which every second is near the one before."""
    import numpy as np
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 16, N.HASHES).astype("<u2")
    sigs = []
    for _ in range(n):
        s = base.copy()
        s[rng.integers(0, N.HASHES, 6)] = rng.integers(0, 1 << 16, 6)
        sigs.append(s)
    for k in range(others):
        s = rng.integers(0, 1 << 16, N.HASHES).astype("<u2") if k % 2 == 0 else sigs[-1].copy()
        s[-1] = k
        s[:N.BAND] = base[:N.BAND]
        sigs.append(s)
    return [(k.to_bytes(4, "big"), s.tobytes()) for k, s in enumerate(sigs)]


def test_large_buckets_connect_what_all_their_pairs_do(spark, monkeypatch):
    import numpy as np
    rows = _group(150, 60)
    classes = spark.createDataFrame(rows, "member binary, sig binary")
    sig = np.frombuffer(b"".join(s for _, s in rows), "<u2").reshape(-1, N.HASHES)
    x, y = np.triu_indices(len(rows), 1)
    shared = (sig.view("<u8")[x] == sig.view("<u8")[y]).any(axis=1)
    x, y = N.prune(sig, x[shared], y[shared], N.least_matches(N.THRESHOLD))
    want = {rows[a][0]: rows[r][0] for a, r in zip(*N._forest(len(rows), x, y))}
    want |= {r: r for r in want.values()}
    made = []
    real = N._surviving
    monkeypatch.setattr(N, "_surviving", lambda units, *a: (made.append(units.count()), real(units, *a))[1])
    got = {bytes(r["member"]): bytes(r["root"]) for r in N.components(N.candidates(classes, block=8)).collect()}
    assert got == want and len(set(want.values())) == 31

    # twice the near copies: the rows compared grow like the copies, not like their square
    few = sum(made)
    made.clear()
    classes = spark.createDataFrame(_group(300, 60), "member binary, sig binary")
    assert len({r["root"] for r in N.components(N.candidates(classes, block=8)).collect()}) == 31
    assert sum(made) < 2.5 * few
