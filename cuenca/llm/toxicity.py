"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as a hashed word vector and the sum of its hashed character
n-gram vectors (3 to 5 characters, with the word's ends), so inflected or unseen
forms of a known stem are recognised. Windows of ``WINDOW`` words, every
``STRIDE`` words and up to the last word, pass through a forward and a backward
GRU; attention pools the states into one logit. A document's score is the
calibrated logit of its highest window, and every window of every document is
scored.

Training is numpy on the driver over a bounded sample of labelled documents:
at most ``FIT`` of either label and ``CALIBRATE`` for calibration, first in hash
order, of at most ``MAX_CHARS`` characters. Only documents whose
crc32(doc_id) mod 5 is not 0 are used. Toxic documents hold harmless windows
too, so only those with their most telling n-grams are trained on, beside the
harmless documents' windows that look most toxic. Calibration is a logistic fit
on other documents,
weighted by the labels' true proportion. Random numbers have a fixed seed.

Defined results: null or empty texts have one empty window and get the score of
it; repeated rows are scored each; a null doc_id is never a training row and
held_out is null; without toxic or harmless labels every score is the share of
toxic labels (0 without labels); an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.llm.common import slices, table
from cuenca.llm.decontaminate import tokens

NAME = "op7_gru_toxicity"
SQL = None               # a trained model; tested by held-out accuracy
WINDOW, STRIDE = 48, 24
FIT, CALIBRATE, MAX_CHARS = 900, 400, 20_000
H, A, WORD_ROWS, WORD_DIM, CHAR_ROWS, CHAR_DIM = 8, 8, 1 << 15, 8, 1 << 17, 8
EPOCHS, BATCH, RATE, SEED = 4, 256, 0.005, 7
STEPS = 240              # at least: few labels make more passes


def word_features(words: list[bytes]):
    """(word rows, n-gram rows, first n-gram of each word) of distinct words."""
    import numpy as np
    from zlib import crc32
    rows = np.array([crc32(w) % WORD_ROWS for w in words], np.int64)
    flat = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint64)
    size = np.array([len(w) + 2 for w in words], np.int64)
    end = np.repeat(np.cumsum(size), size)      # past the word that a byte belongs to
    at = np.arange(len(flat))
    mul = np.uint64(0x9E3779B97F4A7C15)
    grams, where = [], []
    h = flat + np.uint64(1)
    for n in range(2, 6):
        h = h[:-1] * mul + flat[n - 1:]
        if n >= 3:
            ok = np.flatnonzero(at[:len(h)] + n <= end[:len(h)])
            v = (h[ok] ^ (h[ok] >> np.uint64(32))) * mul
            grams.append((v >> np.uint64(47)).astype(np.int64))
            where.append(np.searchsorted(np.cumsum(size), ok, "right"))
    grams, where = np.concatenate(grams), np.concatenate(where)
    order = np.argsort(where, kind="stable")
    where = where[order]
    return rows, grams[order], np.searchsorted(where, np.arange(len(words))), where


def window_starts(n: int) -> list[int]:
    """Starts of the windows that cover ``n`` words."""
    if n <= WINDOW:
        return [0]
    return [*range(0, n - WINDOW, STRIDE), n - WINDOW]


def _sigmoid(x):
    import numpy as np
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Model:
    """The network's parameters, its forward pass and its gradients."""

    def __init__(self, seed: int = SEED):
        import numpy as np
        rng = np.random.default_rng(seed)
        d = WORD_DIM + CHAR_DIM
        f = lambda *s, k=0.3: (rng.standard_normal(s) * k).astype(np.float32)
        self.p = {"word": f(WORD_ROWS, WORD_DIM, k=0.1), "char": f(CHAR_ROWS, CHAR_DIM, k=0.1),
                  "x": f(2, d, 3 * H), "b": np.zeros((2, 3 * H), np.float32), "u": f(2, H, 3 * H),
                  "wa": f(2 * H, A), "va": f(A), "wo": f(2 * H), "bo": np.zeros(1, np.float32)}

    def inputs(self, features):
        import numpy as np
        rows, grams, first, _ = features
        p = self.p
        return np.concatenate([p["word"][rows], np.add.reduceat(p["char"][grams], first, axis=0)], axis=1)

    def project(self, features):
        """What each distinct word adds to the gates of either direction, and
        as the first row a padding word."""
        import numpy as np
        p = self.p
        out = np.einsum("nd,kdh->nkh", self.inputs(features), p["x"]) + p["b"]
        return np.concatenate([np.zeros((1, 2, 3 * H), np.float32), out])

    def forward(self, gates, ids, keep=False):
        """Logits of windows ``ids`` (rows of ``gates``; 0 is padding)."""
        import numpy as np
        p, (n, t) = self.p, ids.shape
        h = np.zeros((2, n, H), np.float32)
        mask = (ids != 0).astype(np.float32)
        states = np.empty((2, t, n, H), np.float32)
        saved = []
        for k in range(t):
            back = t - 1 - k
            g = np.stack([gates[ids[:, k], 0], gates[ids[:, back], 1]])
            hu = h @ p["u"]
            zr = _sigmoid(g[:, :, :2 * H] + hu[:, :, :2 * H])
            z = zr[:, :, :H] * np.stack([mask[:, k], mask[:, back]])[:, :, None]
            r = zr[:, :, H:]
            c = np.tanh(g[:, :, 2 * H:] + r * hu[:, :, 2 * H:])
            if keep:
                saved.append((h, zr, z, r, c, hu[:, :, 2 * H:]))
            h = h + z * (c - h)
            states[0, k], states[1, back] = h[0], h[1]
        s = np.concatenate([states[0], states[1]], axis=2)           # t, n, 2H
        q = np.tanh(s @ p["wa"])
        e = q @ p["va"] - 1e4 * (1 - mask.T)
        e = np.exp(e - e.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, s)
        logit = pooled @ p["wo"] + p["bo"][0]
        return (logit, (mask, saved, s, q, a, pooled)) if keep else logit

    def gradients(self, features, ids, y):
        """Gradients of the mean cross-entropy of windows ``ids``."""
        import numpy as np
        p = self.p
        gates = self.project(features)
        logit, (mask, saved, s, q, a, pooled) = self.forward(gates, ids, keep=True)
        n, t = ids.shape
        dl = ((_sigmoid(logit) - y) / n).astype(np.float32)
        g = {"wo": pooled.T @ dl, "bo": dl.sum(keepdims=True)}
        dp = dl[:, None] * p["wo"]
        ds = a[:, :, None] * dp
        da = np.einsum("tnh,nh->tn", s, dp)
        de = a * (da - (a * da).sum(axis=0))
        g["va"] = np.einsum("tna,tn->a", q, de)
        dq = de[:, :, None] * p["va"] * (1 - q * q)
        g["wa"] = np.einsum("tnh,tna->ha", s, dq)
        ds += dq @ p["wa"].T
        dgates = np.zeros_like(gates)
        du = np.zeros_like(p["u"])
        dh = np.zeros((2, n, H), np.float32)
        ut = p["u"].transpose(0, 2, 1)
        for k in range(t - 1, -1, -1):
            back = t - 1 - k
            h, zr, z, r, c, huc = saved[k]
            dh = dh + np.stack([ds[k, :, :H], ds[back, :, H:]])
            m = np.stack([mask[:, k], mask[:, back]])[:, :, None]
            dc = dh * z * (1 - c * c)
            dz = dh * (c - h) * m * zr[:, :, :H] * (1 - zr[:, :, :H])
            dr = dc * huc * r * (1 - r)
            dg = np.concatenate([dz, dr, dc], axis=2)
            dhu = np.concatenate([dz, dr, dc * r], axis=2)
            du += h.transpose(0, 2, 1) @ dhu
            dh = dh * (1 - z) + dhu @ ut
            np.add.at(dgates[:, 0], ids[:, k], dg[0])
            np.add.at(dgates[:, 1], ids[:, back], dg[1])
        g["u"] = du
        dgates = dgates[1:]
        rows, grams, _, of = features
        x = self.inputs(features)
        g["b"] = dgates.sum(axis=0)
        g["x"] = np.einsum("nd,nkh->kdh", x, dgates)
        dx = np.einsum("nkh,kdh->nd", dgates, p["x"])
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], rows, dx[:, :WORD_DIM])
        np.add.at(g["char"], grams, dx[of, WORD_DIM:])
        return g


def _pick(features, used):
    """The features of some of the words."""
    import numpy as np
    rows, grams, first, _ = features
    last = np.append(first[1:], len(grams))
    n = last[used] - first[used]
    at = np.repeat(first[used] - np.cumsum(n) + n, n) + np.arange(n.sum())
    return rows[used], grams[at], np.cumsum(n) - n, np.repeat(np.arange(len(used)), n)


class _Vocabulary(dict):
    """word -> row, in order of appearance from 1."""

    def __missing__(self, w):
        v = self[w] = len(self) + 1
        return v


def _windows(docs: list[list[int]]):
    """(ids, document) of the windows of documents given as lists of rows."""
    import numpy as np
    starts = [window_starts(len(d)) for d in docs]
    ids = np.zeros((sum(map(len, starts)), WINDOW), np.int32)
    k = 0
    for d, ss in zip(docs, starts):
        d = np.array(d, np.int32)
        for s in ss:
            w = d[s:s + WINDOW]
            ids[k, :len(w)] = w
            k += 1
    return ids, np.repeat(np.arange(len(docs)), [len(s) for s in starts])


def train(fit: list[tuple], calibration: list[tuple], ratio: float):
    """(model, slope, offset) from rows (text, label); ``ratio`` is harmless
    labels over toxic ones."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    vocabulary = _Vocabulary()
    ids, doc = _windows([[vocabulary[w] for w in tokens(t)] for t, _ in fit])
    label = np.array([y for _, y in fit], np.float32)[doc]
    features = word_features(list(vocabulary))
    model, moments, step = Model(), {}, 0
    live = _telling(features, ids, doc, label, [y for _, y in fit])
    per_pass = -(-4 * int(live.sum()) // BATCH)
    for epoch in range(max(EPOCHS, -(-STEPS // per_pass))):
        toxic, clean = np.flatnonzero(live & (label == 1)), np.flatnonzero(label == 0)
        clean = rng.permutation(clean)
        if epoch:   # half of them those that look most toxic
            hard = clean[np.argsort(-logit[clean], kind="stable")[:3 * len(toxic) // 2]]
            clean = np.concatenate([hard, clean[:3 * len(toxic) // 2]])
        clean = clean[:3 * len(toxic)]
        order = rng.permutation(np.concatenate([toxic, clean]))
        for k in range(0, len(order), BATCH):
            at = order[k:k + BATCH]
            used, inner = np.unique(ids[at], return_inverse=True)
            pad = int(used[0] == 0)
            inner = inner.reshape(len(at), WINDOW) + (1 - pad)
            grad = model.gradients(_pick(features, used[pad:] - 1), inner, label[at])
            step += 1
            for name, g in grad.items():
                m, v = moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                model.p[name] -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        logit = _score(model, model.project(features), ids)
    z = np.array([_highest(model, [tokens(t)])[0] for t, _ in calibration])
    y = np.array([l for _, l in calibration], float)
    slope, offset = _logistic(z, y, np.where(y == 1, 1.0, ratio * max(y.sum(), 1) / max((1 - y).sum(), 1)))
    return model, slope, offset


def _telling(features, ids, doc, label, doc_label):
    """The toxic documents' windows to train on: those whose most telling
    n-gram (log-odds of the numbers of documents that hold it) comes near the
    document's most telling one."""
    import numpy as np
    _, grams, first, of = features
    holds = [np.zeros(CHAR_ROWS), np.zeros(CHAR_ROWS)]
    last = np.append(first[1:], len(grams))
    for d, y in enumerate(doc_label):
        words = np.unique(ids[doc == d])
        words = words[words > 0] - 1
        if len(words):
            holds[y][np.unique(np.concatenate([grams[first[w]:last[w]] for w in words]))] += 1
    n1, n0 = max(sum(doc_label), 1), max(len(doc_label) - sum(doc_label), 1)
    odds = np.log((holds[1] + 0.5) / n1) - np.log((holds[0] + 0.5) / n0)
    odds[holds[1] < 3] = -9.0
    by_word = np.concatenate([[-9.0], np.maximum.reduceat(odds[grams], first)])
    telling = by_word[ids].max(axis=1)
    best = np.full(len(doc_label), -np.inf)
    np.maximum.at(best, doc, telling)
    return (label == 1) & (telling >= best[doc] - 1.0)


def _score(model, gates, ids, some: int = 2048):
    import numpy as np
    return np.concatenate([model.forward(gates, ids[k:k + some]) for k in range(0, len(ids), some)] or [np.zeros(0)])


def _highest(model, docs: list[list[bytes]]):
    """The highest window logit of each document."""
    import numpy as np
    vocabulary = _Vocabulary()
    ids, doc = _windows([list(map(vocabulary.__getitem__, ws)) for ws in docs])
    gates = (model.project(word_features(list(vocabulary))) if vocabulary
             else np.zeros((1, 2, 3 * H), np.float32)).astype(np.float32)
    best = np.full(len(docs), -np.inf)
    np.maximum.at(best, doc, _score(model, gates, ids))
    return best


def _logistic(z, y, weight):
    """Slope and offset of a weighted, slightly damped logistic fit; the slope
    is never negative."""
    import numpy as np
    mean, spread = z.mean(), max(z.std(), 1e-6)
    x = np.stack([(z - mean) / spread, np.ones_like(z)], axis=1)
    w = np.zeros(2)
    for _ in range(60):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + 0.1 * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - step / max(1.0, np.abs(step).max())
    slope = max(float(w[0]), 0.01) / spread
    return slope, float(w[1]) - slope * mean


def fold(col: str = "doc_id"):
    """crc32 of doc_id as text, mod 5."""
    return F.crc32(F.col(col).cast("string")) % 5


def sample(docs: DataFrame, labels: DataFrame, bound: int = FIT + CALIBRATE) -> list[tuple]:
    """(text, label) of at most ``bound`` documents of either label."""
    known = labels.where((fold() != 0) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = None
    for y in (0, 1):  # more than needed, as long documents are left out below
        part = known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * bound)
        some = part if some is None else some.unionByName(part)
    rows = (docs.select("doc_id", "text").where(F.length("text") <= MAX_CHARS)
            .join(F.broadcast(some), "doc_id").dropDuplicates(["doc_id"])
            .orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    by = {0: [], 1: []}
    for r in rows:
        by[r["toxic"]].append((r["text"].encode(), r["toxic"]))
    return by[0][:bound] + by[1][:bound]


def score(docs: DataFrame, labels: DataFrame, fit: int = FIT, calibrate: int = CALIBRATE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    spark = docs.sparkSession
    count = {r["toxic"]: r["n"] for r in labels.where(fold() != 0).groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("toxic").isin(0, 1)).collect()}
    n0, n1 = count.get(0, 0), count.get(1, 0)
    rows = sample(docs, labels, fit + calibrate) if n0 and n1 else []
    by = {y: [r for r in rows if r[1] == y] for y in (0, 1)}
    held = lambda y: max(1, len(by[y]) * calibrate // (fit + calibrate))
    if len(by[0]) > 1 and len(by[1]) > 1:
        model = train(by[0][held(0):] + by[1][held(1):], by[0][:held(0)] + by[1][:held(1)], n0 / n1)
    else:
        model = None
    share = n1 / (n0 + n1) if n0 + n1 else 0.0
    # arrays of a fixed size; a class would have to be importable in the workers
    sent = spark.sparkContext.broadcast(model and (model[0].p, *model[1:]))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        net = object.__new__(Model)
        for batch in (s for b in batches for s in slices(b, 4_000_000)):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            if sent.value is None:
                p = np.full(len(texts), share)
            else:
                net.p, slope, offset = sent.value
                z = np.concatenate([_highest(net, [tokens(t or b"") for t in texts[k:k + 128]])
                                    for k in range(0, len(texts), 128)] or [np.zeros(0)])
                p = _sigmoid(slope * z + offset)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
            .select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
