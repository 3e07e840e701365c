import numpy as np
import pytest

from cuenca.llm import mixing as M


def corpus(n=400, seed=2):
    rng = np.random.default_rng(seed)
    names = ["b", "a", None, "é", "src1", "src10", "src2", "z"]
    return [(i, names[0] if rng.random() < 0.35 else names[rng.integers(0, 8)], " ".join(["w"] * int(rng.lognormal(3, 1)))) for i in range(n)]


def plain_targets(size):
    """Sources in order (null last), weights dealt, cut and dealt again."""
    names = sorted([s for s in size if s is not None]) + ([None] if None in size else [])
    weight = {s: M.WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, cut = 1.5 * sum(size.values()), {}
    while True:
        left = [s for s in names if s not in cut]
        level = (total - sum(cut.values())) / max(sum(weight[s] for s in left), 1)
        over = [s for s in left if weight[s] * level > 2 * size[s]]
        if not over:
            return cut | {s: weight[s] * level for s in left}
        cut |= {s: 2.0 * size[s] for s in over}


def run(spark, rows):
    return M.mix(spark.createDataFrame(rows, "doc_id long, source string, text string"))


def test_targets_rates_and_copies(spark):
    rows = corpus()
    got = run(spark, rows).collect()
    size = {}
    for _, s, t in rows:
        size[s] = size.get(s, 0) + len(t.split())
    want = plain_targets(size)
    by = {}
    for r in got:
        assert r.size == len(rows[r.doc_id][2].split()) and r.taken == r.copies * r.size <= 2 * r.size
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert abs(r.copies - r.rate) < 1
        by.setdefault(r.source, []).append(r)
    for s, rs in by.items():
        n, rate = np.array([r.size for r in rs]), np.array([r.rate for r in rs])
        assert (n * rate).sum() == pytest.approx(want[s], abs=1.5)              # the constraint holds
        assert abs(sum(r.taken for r in rs) - want[s]) <= 0.5 * n.max() + 2     # and so do the copies
        if want[s] < 2 * size[s]:                                               # the tilt is exponential
            free = (rate < 2) & (n > 0)
            lam = np.log(rate[free] / 1.5) / n[free]
            assert lam.max() - lam.min() < 1e-9


def test_reruns_agree(spark):
    rows = corpus(seed=4)
    a = {(r.doc_id, r.copies) for r in run(spark, rows).collect()}
    b = {(r.doc_id, r.copies) for r in run(spark, rows[::-1]).repartition(7).collect()}
    assert a == b


def test_nulls_empty_texts_ties_clashes(spark):
    rows = [(None, None, None, 9, "x"), (1, "s", "", 9, "x"), (2, "s", "a b", 9, "x"), (2, "s", "a b", 9, "x"), (3, None, "c " * 50, 9, "x")]
    out = M.mix(spark.createDataFrame(rows, "doc_id long, source string, text string, size int, copies string")).collect()
    assert len(out) == 5 and sorted(r.size for r in out) == [0, 0, 2, 2, 50]
    assert all(r.taken == 0 for r in out if r.size == 0)
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    assert M.mix(none).count() == 0
    empty = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [(r.target, r.taken) for r in M.mix(empty).collect()] == [(0.0, 0), (0.0, 0)]
