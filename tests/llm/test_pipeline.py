import corpus_pipeline as C
from cuenca.llm import load

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_of_documents(spark):
    docs = C.table(spark, SF, "documents")
    before = None
    for name, stage in C.STAGES[:-1]:
        docs = C.materialize(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        assert before is None or ids <= before
        before = ids
    out = C.materialize(C.STAGES[-1][1](spark, docs, SF)).collect()
    assert len(out) == docs.count()
    end = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == end
        end += r.n_tokens


def test_every_operator_has_one_query():
    queries, sql = load()
    assert sorted(int(k[2:].split("_")[0]) for k in queries) == list(range(1, 14)) and set(sql) <= set(queries)


def test_every_stage_equals_a_plain_version(spark, duck):
    """Each stage on what the one before kept, against SQL or brute force."""
    from tokenizers import Tokenizer

    from cuenca.llm import decontaminate as D, quality_llr, token_files
    from llm.test_mixing import plain_targets
    from llm.test_ngram_join import brute
    from llm.test_token_files import want
    stage = dict(C.STAGES)
    rows = lambda df: [(r.doc_id, r.text, r.source) for r in df.collect()]

    docs = C.materialize(stage["quality rules"](spark, C.table(spark, SF, "documents"), SF))
    kept = {d for d, k in duck.sql(f"SELECT doc_id, kept FROM ({quality_llr.SQL})").fetchall() if k}
    assert {d for d, *_ in rows(docs)} == kept and 0 < len(kept) < 200

    texts = [(d, t) for d, t, _ in rows(docs)]
    docs = C.materialize(stage["n-gram Jaccard join"](spark, docs, SF))
    assert {d for d, *_ in rows(docs)} == {d for d, root, _ in brute(texts) if d == root}

    h, items = D._Hash(), [r.text for r in C.table(spark, SF, "benchmark").collect()]
    items = [h.of(D.tokens(t.encode())) for t in items if t]
    def leaks(text):
        doc = h.of(D.tokens(text.encode()))
        return any(len(i) and sum(x[2] for x in D.tile(doc, i)) >= D.COVERAGE * len(i) for i in items)
    want_ids = {d for d, t, _ in rows(docs) if not leaks(t)}
    docs = C.materialize(stage["benchmark decontamination"](spark, docs, SF))
    assert {d for d, *_ in rows(docs)} == want_ids

    size, longest, before = {}, {}, rows(docs)
    for _, t, s in before:
        n = len(t.encode().split())
        size[s], longest[s] = size.get(s, 0) + n, max(longest.get(s, 0), n)
    docs = C.materialize(stage["mixing sources"](spark, docs, SF))
    taken, copies = dict.fromkeys(size, 0), {}
    for d, t, s in rows(docs):
        taken[s] += len(t.encode().split())
        copies[d] = copies.get(d, 0) + 1
    target = plain_targets(size)
    assert max(copies.values()) <= 2 and set(copies) <= {d for d, *_ in before}
    assert all(abs(taken[s] - target[s]) <= 0.5 * longest[s] + 2 for s in size)

    got = {tuple(r) for r in stage["token-ID output"](spark, docs, SF).collect()}
    ordered = sorted(((d, t) for d, t, _ in rows(docs)))
    assert got == want(Tokenizer.from_file(token_files.tokenizer_file()), ordered)


COLUMNS = ("doc_id long, text string, lang string, source string, n_chars long, kept string, size string, member string, "
           "copies string, n_tokens string, start string, _h string")


def folder(spark, path, rows, labels, bench):
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark, tmp_path):
    import os

    from cuenca.session import scratch_path
    words = lambda k: " ".join(f"w{k}x{n}" for n in range(60))
    more = (None, "x", "y", "1", "z", "0", "h")
    rows = [(k, words(k), "en", "s", 1, *more) for k in range(12)]
    rows += [(3, words(3), "en", "s", 1, *more), (None, words(50), None, None, None, *more), (None, None, None, None, None, *more),
             (20, None, "en", "s", None, *more), (21, "", "en", None, 0, *more), (22, "short", "en", "s", 5, *more),
             (23, words(4), "en", "t", 1, *more), (24, words(60) + " one two three four five six", "en", "t", 1, *more)]
    sf = folder(spark, tmp_path / "a", rows, [(k, 1, 0) for k in range(6)] + [(None, 1, 0)], [(1, "one two three four five six"), (2, None)])
    before = set(os.listdir(scratch_path(spark, "")))
    out = C.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    ids = {r.doc_id for r in out.collect()}
    # empty and short texts fail the quality rules, 23 copies 4, 24 holds a benchmark item
    assert ids <= set(range(12)) | {None} and len(ids) >= 8
    # one result and the token files are what a run leaves behind
    left = set(os.listdir(scratch_path(spark, ""))) - before
    assert sorted(d.split("-")[0] for d in left if not d.endswith(".crc")) == ["mat", "tokens"]


def test_empty_tables(spark, tmp_path):
    assert C.run(spark, folder(spark, tmp_path / "b", [], [], [])).collect() == []
    rows = [(1, "word " * 60 + " ".join(f"u{n}" for n in range(80)), "en", "s", 1, *[None] * 7)]
    assert {r.doc_id for r in C.run(spark, folder(spark, tmp_path / "c", rows, [], [])).collect()} == {1}
