import pytest

from pyspark.sql import functions as F

from cuenca.llm import quality_llr as Q

LABELS = "doc_id long, quality int, toxic int"


def corpus():
    good = "the cat sat on the mat and looked at the moon while rain fell over the old town".split()
    rows, labels = [], []
    for i in range(60):
        k = i % len(good)
        rows.append((i, " ".join((good[k:] + good[:k]) * 3 + [f"u{i}x{j}" for j in range(60)])))
        labels.append((i, 1, 0))
    for i in range(60, 80):
        rows.append((i, " ".join(f"{w}$$$" for w in good * 3) + " " + " ".join(f"v{i}y{j}" for j in range(60))))
        labels.append((i, 0, 0))
    return rows, labels


def plain_stats(text):
    t = text or ""
    ws = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in t).split(" ") if w]
    wins = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    cover = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if any(c not in " \t\n\v\f\r" for c in x)]
    return (len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(cover))


def test_statistics_equal_a_plain_count(spark):
    texts = ["a b c a b c d", "x\nx\n \ny\tz\vq", "é€😀 #*$%&|<> é€😀", "a a a a a", "", None, "  a\x1cb", "one two", "w " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in Q.score(docs, spark.createDataFrame([], LABELS)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        want = plain_stats(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed)     # no labels: only the base rule decides


def test_score_equals_a_plain_model(spark):
    from collections import Counter
    from hashlib import md5
    from math import floor, log
    rows, labels = corpus()

    def grams(t):
        h = [int(md5(w.encode()).hexdigest()[:8], 16) for w in t.split()]
        return [x % 32768 for x in h] + [32768 + (a * 2654435 + b) % 32749 for a, b in zip(h, h[1:])]

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if labels[i][1] == 1 and i % 2 == 0:
            target.update(grams(t))
    nr, nt = sum(raw.values()), sum(target.values())
    lr = {b: round(1e6 * log((target[b] + 1) * (nr + 65536) / ((raw[b] + 1) * (nt + 65536)))) for b in raw}
    got = {r.doc_id: r for r in Q.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()}
    for i, t in rows:
        g = grams(t)
        assert got[i].llr == pytest.approx(floor(sum(lr[b] for b in g) / len(g)) / 1e6, abs=1e-12)
    assert all(got[i].kept for i in range(60)) and not any(got[i].kept for i in range(60, 80))


def test_nulls_empty_tables_clashing_columns(spark):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, 1), (2, 1, 0), (2, 1, 0)], LABELS)
    docs = spark.createDataFrame([(None, None, 5, "x"), (2, "a " * 60, 6, "y"), (2, "a " * 60, 6, "y")],
                                 "doc_id long, text string, n_words int, kept string")
    out = Q.score(docs, labels).collect()
    assert len(out) == 3 and {r.n_words for r in out} == {0, 60}
    assert Q.score(docs.limit(0), labels).count() == 0


def test_threshold_rests_on_all_labelled_documents(spark):
    import random
    rng = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    rows = [(2 * i + 1, " ".join(rng.choices(words, k=60))) for i in range(24_000)]
    rows += [(2 * i, " ".join(rng.choices(words[:200], k=60))) for i in range(200)]
    labels = [(i, int(i % 200 != 1), 0) for i, _ in rows]
    out = Q.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)).collect()
    llr = {r.doc_id: round(r.llr * 1e6) for r in out if not r.base_failed}
    good = sorted(llr[i] for i, q, _ in labels if q and i % 2 and i in llr)
    g = good[int(0.001 * len(good))]
    bad = [llr[i] for i, q, _ in labels if not q and i % 2 and i in llr and llr[i] < g]
    least = (g + max(bad)) // 2 if bad else g
    assert len(good) > 20_000 and all(r.kept == (llr[r.doc_id] >= least) for r in out if not r.base_failed)


def test_verdicts_equal_scores_and_measure_once(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    cols = ["doc_id", "n_words", "llr", "base_failed", "kept"]
    one = Q.verdicts(docs, labels)
    assert sorted(map(tuple, one.select(cols).collect())) == sorted(map(tuple, Q.score(docs, labels).select(cols).collect()))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Exchange" not in plan      # a filter on written numbers


def test_bitmap_keeps_every_known_document(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    ids = spark.range(0, 3000, 7).select(F.col("id").alias("doc_id"))
    found = Q.likely(docs, ids)
    assert ids.exceptAll(found.select("doc_id")).count() == 0 and found.count() < 600
    assert Q.likely(docs, ids.limit(0)).count() == 0


def test_session_settings_stay(spark):
    keys = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(k) for k in keys]
    from cuenca.llm import token_files
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    token_files.encode(docs).collect()
    Q.score(docs, spark.createDataFrame([], LABELS)).collect()
    assert [spark.conf.get(k) for k in keys] == before
