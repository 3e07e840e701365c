"""The trained operators: toxicity and secrets."""
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from cuenca.llm import secrets as S, toxicity as X


def toxic_corpus(n=500, seed=1):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        ws = [rng.choice(vocab) for _ in range(rng.randint(5, 150))]
        y = int(i % 4 == 0)
        for _ in range(y * (1 + len(ws) // 40)):
            ws[rng.randrange(len(ws))] = "zkwj" + rng.choice(vocab) if rng.random() < 0.5 else "grumpf"
        rows.append((i, " ".join(ws)))
        labels.append((i, 1, y))
    return rows, labels


def test_toxicity_held_out_accuracy(spark):
    rows, labels = toxic_corpus()
    docs = spark.createDataFrame(rows + [(9001, ""), (9002, None), (None, "x")], "doc_id long, text string")
    out = {r.doc_id: r for r in X.score(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert len(out) == len(rows) + 3 and out[9001].score == out[9002].score and out[None].held_out is None
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (i in set(held)) for i, _ in rows)
    y = np.array([labels[i][2] for i in held])
    p = np.array([out[i].score for i in held])
    auc = (p[y == 1][:, None] > p[y == 0]).mean()
    assert auc > 0.9 and ((p >= 0.5) == y).mean() > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())


def test_toxicity_without_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, "a b", 0.5)], "doc_id long, text string, score double")
    assert [r.score for r in X.score(docs, none).collect()] == [0.0]
    one = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    assert [r.predicted for r in X.score(docs, one).collect()] == [1]
    assert X.score(docs.limit(0), none).count() == 0


def test_windows_cover_all_words():
    for n in (0, 1, 47, 48, 49, 72, 73, 500):
        at = X.window_starts(n)
        assert {i for s in at for i in range(s, min(n, s + X.WINDOW))} == set(range(n))
        assert all(b - a <= X.STRIDE for a, b in zip(at, at[1:]))


@pytest.mark.parametrize("module", ["toxicity", "secrets"])
def test_gradients_equal_differences(module):
    if module == "toxicity":
        net, f = X.Model(), X.word_features([b"idiot", b"the", b"of", b"ab"])
        ids, y = np.array([[1, 2, 3], [4, 0, 0], [2, 2, 1]]), np.array([1.0, 0, 1])
        z = lambda: net.forward(net.project(f), ids)
        grad = lambda: net.gradients(f, ids, y)
    else:
        net, x, y = S.Network(), S.views(b"key ghp_12345abcdefg mail3.example.com", [(4, 20), (21, 38)]), np.array([1.0, 0])
        z = lambda: net.forward(x)
        grad = lambda: net.gradients(x, y)
    for k in net.p:
        net.p[k] = net.p[k].astype(float)

    def loss():
        p = 1 / (1 + np.exp(-z()))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g = grad()
    for k, v in net.p.items():
        i = np.unravel_index(np.argmax(np.abs(g[k])), v.shape)
        old, e = v[i], 1e-4
        v[i] = old + e
        a = loss()
        v[i] = old - e
        b = loss()
        v[i] = old
        assert g[k][i] == pytest.approx((a - b) / (2 * e), rel=1e-3, abs=1e-7), k


ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
TEXTS = ['tOkEn="abcdefgh" ſecret=12345678 é password : x1234567890', "AKIAAKIA1234567890 AKIA123", "a" * 100, "secret=short token=longenough1", "é" * 9 + "0123456789abcdef" * 2,
         None, "", "api_key: 'zzzzzzzz' APIKEY=yyyyyyyyy", "password=" + "d" * 40, "9" * 5000]


def plain(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32])


def test_secrets_base_equals_the_plain_rules(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, None, None)], "doc_id long, text string, spans string")
    out = S.scan(df, labelled=[]).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        spans = plain(TEXTS[r.doc_id] if r.doc_id is not None else None)
        listed = [f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for _, x, _ in spans) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("model")] == listed
    assert S.scan(df.limit(0), labelled=[]).count() == 0


def test_secrets_held_out_findings():
    net, slope, offset, least = S.train(S.generated())
    from cuenca.llm.toxicity import _sigmoid
    new = S.generated(600, seed=99)
    p = np.array([_sigmoid(slope * net.forward(S.views(b, [(s, e)])) + offset)[0] for b, s, e, _ in new])
    y = np.array([l for *_, l in new])
    assert (p[y == 1] >= least).mean() > 0.94 and (p[y == 0] >= least).mean() < 0.03


def test_secret_windows_cover_the_candidate():
    for n in (8, 40, 41, 59, 60, 61, 71, 100, 500):
        ws = S.windows(3, 3 + n)
        assert {i for s, e in ws for i in range(s, e)} == set(range(3, 3 + n))
        assert ws[-1][1] == 3 + n and all(e - s == min(n, S.LENGTH) for s, e in ws)
        assert all(b[0] - a[0] <= S.STRIDE for a, b in zip(ws, ws[1:]))


def test_secrets_late_in_a_long_run_are_found(spark):
    rng = random.Random(5)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda k: "".join(rng.choice(alnum) for _ in range(k))
    hooks = [f"see https://hooks.slack.com/services/T00000000/B00000000/{key(24)} now" for _ in range(40)]
    paths = [f"see https://www.example.com/{'/'.join(['docs', 'guide', '2024', 'some-page'] * 8)}/{key(32)} now" for _ in range(40)]
    plain = [f"see https://www.example.com/{'/'.join(['docs', 'guide', '2024', 'some-page'] * k)}/index.html now" for k in range(1, 41)]
    rows = [(i, t) for i, t in enumerate(hooks + paths + plain)]
    got = {r.doc_id: r.n_model for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string"), labelled=[]).collect()}
    assert sum(got[i] > 0 for i in range(40)) >= 36 and sum(got[i] > 0 for i in range(40, 80)) >= 36
    assert sum(got[i] > 0 for i in range(80, 120)) <= 4


def test_secrets_of_letters_alone_are_found_and_words_are_not(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    bearer = ["Authorization: Bearer AbCdEfGhIjKlMnOpQrStUvWx"] + [
        "Authorization: Bearer " + "".join(rng.choice(letters) for _ in range(24)) for _ in range(49)]
    syllable = lambda: rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice(["", "n", "r", "s"])
    prose = [" ".join("".join(syllable() for _ in range(rng.randint(1, 6))) for _ in range(80)) for _ in range(50)]
    rows = list(enumerate(bearer + prose))
    got = {r.doc_id: r.n_model for r in S.scan(spark.createDataFrame(rows, "doc_id long, text string"), labelled=[]).collect()}
    assert got[0] == 1 and sum(got[i] > 0 for i in range(50)) >= 47
    assert sum(got[i] for i in range(50, 100)) <= 20        # of some 2,000 long words


def test_secret_views_equal_a_plain_copy():
    b = b"ab " + b"x" * 90 + " é end".encode()
    for spans in ([(3, 13)], [(3, 43), (53, 93)], [(0, 2), (94, len(b))], []):
        got = S.views(b, spans)
        for row, (s, e) in zip(got, spans):
            before, body, after = b[max(0, s - S.BEFORE):s], b[s:min(e, s + S.LENGTH)], b[e:e + S.AFTER]
            want = bytes(S.BEFORE - len(before)) + before + body + bytes(S.LENGTH - len(body)) + after + bytes(S.AFTER - len(after))
            assert row.tolist() == [min(c, 128) for c in want]
        assert len(got) == len(spans)


def test_scan_runs_from_another_folder(tmp_path):
    """Workers get the functions by value: the package is not on their path."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
from cuenca.session import get_session
spark = get_session("local[2]", shuffle_partitions=2)
from cuenca.llm import secrets, ctph, fim, html_extract, merkle
docs = spark.createDataFrame([(1, "Bearer ghp_12345abcdefgh12345abcdefgh", "s", "en", 5)], "doc_id long, text string, source string, lang string, n_chars int")
assert secrets.scan(docs, labelled=[]).count() == 1 and fim.transform(docs).count() == 1
assert ctph.edited(docs).count() == 1 and merkle.verify(merkle.build(docs)).count() == 1
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "done" in out.stdout, out.stderr[-2000:]
