import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from cuenca.llm import token_files as K

TEXTS = ["plain words here", "two  spaces", "line\nline\n\nline ", "\ttab", "<|endoftext|> inside", "don't 'tis it's", "é² x1 _a 日本語 テスト.", "",
         None, "a b", "same text", "same text", "x" * 5000, "ﬁn ª ß. Ö!?", "end\n"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(K.tokenizer_file())


def want(tokenizer, rows):
    out, start = set(), 0
    for d, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        out.add((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_equals_the_tokenizer(spark, tokenizer):
    rows = list(enumerate(TEXTS * 7))
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string")
    got = {tuple(r) for r in K.encode(docs, partitions=5).collect()}
    assert got == want(tokenizer, rows)


def test_file_format(spark, tokenizer, tmp_path):
    path = str(tmp_path / "tokens")
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 6) for _ in range(200)) for _ in range(1500)]
    docs = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    K.write_tokens(docs, path, keep=("source",), partitions=1, row_group=100_000, page=10_000)
    files = list((tmp_path / "tokens").glob("*.parquet"))
    assert len(files) == 1
    meta = pq.ParquetFile(files[0]).metadata
    assert meta.num_row_groups > 1
    cols = {meta.row_group(0).column(k).path_in_schema: meta.row_group(0).column(k) for k in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in cols["doc_id"].encodings
    assert any("DICTIONARY" in e for e in cols["ids.list.element"].encodings)
    assert cols["doc_id"].has_column_index and cols["doc_id"].has_offset_index
    part = spark.read.parquet(path).where("doc_id between 100 and 102").select("doc_id", "ids")
    assert {r.doc_id: r.ids for r in part.collect()} == {i: tokenizer.encode(texts[i], add_special_tokens=False).ids + [0] for i in (100, 101, 102)}
    one = K.read_tokens(spark, path)
    assert [r.doc_id for r in one.orderBy("start").collect()] == list(range(1500))


def test_nulls_ties_empty_table(spark, tokenizer):
    docs = spark.createDataFrame([(None, "x", 1), (3, "b", 2), (3, "b", 2), (1, None, None)], "doc_id long, text string, n_tokens int")
    got = sorted(K.encode(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 3, 3] and got[1].n_tokens == 1
    assert K.encode(docs.limit(0)).count() == 0


def test_memory_bound_changes_nothing(monkeypatch, tokenizer):
    monkeypatch.setattr(K, "CACHE", 3)
    with open(K.tokenizer_file(), "rb") as f:
        enc = K.Encoder(f.read())
    for t in [x or "" for x in TEXTS] * 2:
        assert np.frombuffer(enc(t), "<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_a_word_is_remembered_once_whatever_stops_follow(tokenizer):
    with open(K.tokenizer_file(), "rb") as f:
        enc = K.Encoder(f.read())
    text = "aa bb, bb. bb; bb?! cc\nbb, bb"
    ids = enc.batch([text], 0)[0][:-1].tolist()
    assert ids == enc.tok.encode(text, add_special_tokens=False).ids
    assert sorted(enc.pieces) == ["\naa", "\nbb", "bb", "cc"]
