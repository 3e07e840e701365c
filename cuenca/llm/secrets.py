"""Secret scans with a character convolutional network.

Base rules find assignments, access keys and long hex runs. Beside them every
candidate, a run of ``[A-Za-z0-9+/_=.-]`` of ``SHORTEST`` characters or more,
is scored with its surroundings: ``BEFORE`` characters before it,
``LENGTH`` of it and ``AFTER`` characters after that. A longer candidate is scored
in overlapping windows, one every ``STRIDE`` characters and the last one ending at
its end, and has the highest of their scores. Characters are embedded, convolved (width ``WIDTH``), rectified, pooled by maximum and mean and
read by a logistic layer.

The network is trained in numpy on the driver on labelled findings: candidates
of a bounded sample of documents (``SAMPLE``, first in hash order), labelled by
the base rules, and generated findings of known formats (keys, tokens, dates,
numbers, identifiers, paths). A part of them is held out for a logistic
calibration and for the threshold: the highest that still finds ``RECALL`` of
the held-out secrets. Candidates at or above it that touch no base span are
added as spans of kind ``model``. Random numbers have a fixed seed.

Defined results: a null or empty text has no spans; repeated rows are reported
each; null ids pass through; on an empty table the network is trained on the
generated findings alone and there are no rows; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from cuenca.llm.common import slices, table
from cuenca.llm.toxicity import _logistic, _sigmoid

NAME = "op8_cnn_secrets"
SQL = None               # a trained model; base spans tested against the plain rules
SHORTEST, BEFORE, LENGTH, AFTER, WIDTH = 8, 16, 40, 4, 5
STRIDE = 20              # between the windows of a candidate longer than LENGTH
SAMPLE, FINDINGS, GENERATED, RECALL = 2000, 9000, 4000, 0.98
EMBED, FILTERS, EPOCHS, BATCH, RATE, SEED = 8, 24, 6, 128, 0.01, 11

#: fixed values of the contract; byte patterns, so only ASCII letters fold
ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "model")
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=.-]{%d,}" % SHORTEST)


def base_spans(b: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, stop) in bytes of the base rules' matches."""
    out = []
    if b"=" in b or b":" in b:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(b) if len(m[1]) >= 8]
    if b"AKIA" in b:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(b) if len(m[0]) >= 16]
    # runs of 32 or more: shorter runs hold no match and none can start inside one
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(b)]
    return sorted(out)


def candidates(b: bytes, base) -> list[tuple[int, int]]:
    """(start, stop) in bytes of the candidates, those inside base spans too."""
    return [m.span() for m in CANDIDATE.finditer(b)]


def windows(s: int, e: int) -> list[tuple[int, int]]:
    """The candidate itself, or overlapping windows of ``LENGTH`` that cover it."""
    if e - s <= LENGTH:
        return [(s, e)]
    return [(k, k + LENGTH) for k in (*range(s, e - LENGTH, STRIDE), e - LENGTH)]


def highest(scores, counts):
    """The highest score of each candidate, which has ``counts`` windows."""
    import numpy as np
    return np.maximum.reduceat(scores, np.cumsum(counts) - counts) if len(counts) else scores


def views(b: bytes, spans):
    """One row of characters per window: before, the window, after; 0 beyond
    the text and after a short window."""
    import numpy as np
    s, e = np.array(spans, np.int64).reshape(-1, 2).T[:, :, None]
    at = np.concatenate([s - BEFORE + np.arange(BEFORE), s + np.arange(LENGTH), e + np.arange(AFTER)], axis=1)
    there = (at >= 0) & (at < len(b))
    there[:, BEFORE:BEFORE + LENGTH] &= at[:, BEFORE:BEFORE + LENGTH] < e
    text = np.minimum(np.frombuffer(b, np.uint8), 128)
    return np.where(there, text[np.clip(at, 0, max(len(b) - 1, 0))], 0).astype(np.uint8) if len(b) else np.zeros(at.shape, np.uint8)


class Network:
    """Parameters, forward pass and gradients of the convolutional network."""

    def __init__(self, seed: int = SEED, parameters: dict | None = None):
        import numpy as np
        if parameters is not None:
            self.p = parameters
            return
        rng = np.random.default_rng(seed)
        f = lambda *s, k: (rng.standard_normal(s) * k).astype(np.float32)
        self.p = {"e": f(129, EMBED, k=0.3), "w": f(WIDTH * EMBED, FILTERS, k=0.15),
                  "b": np.zeros(FILTERS, np.float32), "o": f(2 * FILTERS, k=0.2), "c": np.zeros(1, np.float32)}

    def forward(self, x, keep=False):
        import numpy as np
        p = self.p
        e = p["e"][x]
        n, length, _ = e.shape
        cols = np.concatenate([e[:, k:length - WIDTH + 1 + k] for k in range(WIDTH)], axis=2)
        a = np.maximum(cols @ p["w"] + p["b"], 0)
        if not keep:
            return np.concatenate([a.max(axis=1), a.mean(axis=1)], axis=1) @ p["o"] + p["c"][0]
        top = a.argmax(axis=1)
        pooled = np.concatenate([np.take_along_axis(a, top[:, None], 1)[:, 0], a.mean(axis=1)], axis=1)
        z = pooled @ p["o"] + p["c"][0]
        return z, (cols, a, top, pooled)

    def gradients(self, x, y):
        import numpy as np
        p = self.p
        z, (cols, a, top, pooled) = self.forward(x, keep=True)
        n, steps, _ = a.shape
        dz = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
        g = {"o": pooled.T @ dz, "c": dz.sum(keepdims=True)}
        dp = dz[:, None] * p["o"]
        da = np.repeat(dp[:, None, FILTERS:] / steps, steps, axis=1)
        np.put_along_axis(da, top[:, None], np.take_along_axis(da, top[:, None], 1) + dp[:, None, :FILTERS], 1)
        da = da * (a > 0)
        g["w"] = np.einsum("ntc,ntf->cf", cols, da, optimize=True)
        g["b"] = da.sum(axis=(0, 1))
        dc = da @ p["w"].T
        de = np.zeros((n, x.shape[1], EMBED), np.float32)
        for k in range(WIDTH):
            de[:, k:k + steps] += dc[:, :, k * EMBED:(k + 1) * EMBED]
        g["e"] = np.zeros_like(p["e"])
        np.add.at(g["e"], x, de)
        return g


def generated(n: int = GENERATED, seed: int = SEED) -> list[tuple[bytes, int, int, int]]:
    """(text, start, stop, label) of ``n`` findings of known formats. Of a secret
    inside a longer run it is the window that holds most of the secret."""
    import random
    rng = random.Random(seed)
    letters, digits, hexa = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    alnum = letters + letters.upper() + digits
    some = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    word = lambda: some(letters, rng.randint(2, 9))
    # words of prose: consonants and vowels by turns
    long_word = lambda: "".join(some("bcdfghklmnprstvz", 1) + some("aeiou", 1) + some(("", "n", "r", "s", "l"), 1) for _ in range(rng.randint(4, 7)))
    secret = [lambda: "ghp_" + some(alnum, 36), lambda: "xoxb-" + some(digits, 11) + "-" + some(alnum, 24),
              lambda: "AIza" + some(alnum + "_-", 35), lambda: "sk_live_" + some(alnum, 24), lambda: "glpat-" + some(alnum, 20),
              lambda: "eyJ" + some(alnum, 17) + "." + some(alnum + "_-", 40) + "." + some(alnum + "_-", 30),
              lambda: "AKIA" + some(letters.upper() + digits, 16), lambda: some(hexa, rng.choice((32, 40, 64))),
              lambda: some(alnum + "+/", 40), lambda: some(alnum, rng.randint(20, 32)), lambda: some(hexa, rng.randint(16, 24)),
              lambda: some(letters + letters.upper(), rng.randint(20, 32)), lambda: some(letters.upper(), rng.randint(24, 32))]
    plain = [lambda: word() + "." + some(digits, 2), lambda: "mail" + some(digits, 1) + ".example.com", lambda: some(digits, rng.randint(8, 19)),
             lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), lambda: "-".join((some("12", 1) + some(digits, 3), some("01", 1) + some(digits, 1), some("012", 1) + some(digits, 1))),
             lambda: "555-" + some(digits, 4), lambda: word() + "_" + word() + some(digits, 1), lambda: word() + "/" + word() + "/" + word() + some(digits, 2),
             lambda: "v" + ".".join(some(digits, 1) for _ in range(3)) + "-" + word(), lambda: word().capitalize() + word().capitalize() + some(digits, 2),
             lambda: some(digits, 1) + "." + some(digits, 6), lambda: word() + some(digits, rng.randint(1, 3)) + "-" + word(),
             lambda: long_word(), lambda: long_word().capitalize(), lambda: long_word().upper(), lambda: word() + "-" + long_word() + "." + word()]
    part = [word, word, lambda: word() + "-" + word() + "-" + word(), lambda: some("12", 1) + some(digits, 3), lambda: some(digits, 2),
            lambda: some(letters.upper(), 1) + some(digits, 8), lambda: word() + "=" + some(digits, 2), lambda: word() + "_" + word() + ".html"]
    path = lambda: "//" + word() + ".example.com/" + "/".join(rng.choice(part)() for _ in range(rng.randint(4, 12)))
    cue = ("key ", "token: ", "use ", "secret is ", "Authorization: Bearer ", "the ", "with ", "password ", "", "api-key ")
    out = []
    for k in range(n):
        label = k % 2
        body = rng.choice(secret if label else plain)()
        before = " ".join(word() for _ in range(3)) + " " + (rng.choice(cue) if label else "")
        if k % 10 >= 8:          # one in five is, or lies in, a longer run
            run = path()
            full = f"{run}/{body}" if label else run
            if label:
                at = len(full) - len(body)
                s, e = max(windows(0, len(full)), key=lambda w: min(w[1], len(full)) - max(w[0], at))
            else:
                s, e = 0, len(full)
            out.append((f"{before}{full} {word()} {word()}".encode(), len(before) + s, len(before) + e, label))
            continue
        text = f"{before}{body} {word()} {word()}"
        out.append((text.encode(), len(before), len(before) + len(body), label))
    return [x for x in out if x[2] - x[1] >= SHORTEST]


def findings(docs: DataFrame, bound: int = SAMPLE) -> list[tuple[bytes, int, int, int]]:
    """Labelled candidates of at most ``bound`` documents of at most 20,000 characters: 1 where a base span covers them, else 0. Of a candidate
    longer than ``LENGTH`` it is the part that the base spans cover."""
    some = (docs.select("doc_id", "text").where(F.length("text") <= 20_000)
            .select("text", F.xxhash64("doc_id", "text").alias("h")))
    # the share of hashes that holds about ``bound`` documents: no task and not
    # the driver gets more than its part of them, whatever the input
    share = min(1.0, 1.2 * bound / max(some.count(), 1))
    rows = sorted(some.where(F.pmod("h", F.lit(1 << 32)) < F.lit(int(share * (1 << 32)))).collect(), key=lambda r: (r["h"], r["text"]))
    hits, others = [], []
    for r in rows[:bound]:
        b = r["text"].encode()
        base = base_spans(b)
        for s, e in candidates(b, base):
            hit = [(x, y) for x, _, y in base if x < e and s < y]
            if hit and e - s > LENGTH:
                s, e = max(s, hit[0][0]), min(e, max(y for _, y in hit))
            (hits if hit else others).append((b, s, e, int(bool(hit))))
    # words without a secret abound: an even share of them, in the order of the hashes
    step = max(1, len(others) // FINDINGS)
    return hits[:FINDINGS // 3] + others[::step][:FINDINGS]


def train(labelled: list[tuple[bytes, int, int, int]], recall: float = RECALL):
    """(network, slope, offset, threshold) of labelled findings."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    parts = [views(b, windows(s, e)) for b, s, e, _ in labelled]
    label = np.array([l for *_, l in labelled], np.float32)
    order = rng.permutation(len(parts))
    held, fit = order[:len(parts) // 5], order[len(parts) // 5:]
    x, y = np.concatenate(parts), np.repeat(label, [len(v) for v in parts])
    # the fit takes every window of its findings, the held-out findings their highest
    fit = np.flatnonzero(np.isin(np.repeat(np.arange(len(parts)), [len(v) for v in parts]), fit))
    net, moments, step = Network(), {}, 0
    for _ in range(EPOCHS):
        fit = rng.permutation(fit)
        for k in range(0, len(fit), BATCH):
            grad = net.gradients(x[fit[k:k + BATCH]], y[fit[k:k + BATCH]])
            step += 1
            for name, g in grad.items():
                m, v = moments.setdefault(name, (np.zeros_like(g), np.zeros_like(g)))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[name] -= (RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    z = highest(net.forward(np.concatenate([parts[k] for k in held])), np.array([len(parts[k]) for k in held]))
    t = label[held]
    slope, offset = _logistic(z.astype(float), t.astype(float), np.ones(len(t)))
    p = np.sort(_sigmoid(slope * z + offset)[t == 1])
    least = float(p[int((1 - recall) * len(p))]) if len(p) else 0.5
    return net, slope, offset, least


def scan(docs: DataFrame, labelled: list | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_model) of every document."""
    spark = docs.sparkSession
    net, *rest = train((labelled if labelled is not None else findings(docs)) + generated())
    model = spark.sparkContext.broadcast((net.p, *rest))  # arrays of a fixed size

    def run(batches):
        import hashlib
        import numpy as np
        import pyarrow as pa
        parameters, slope, offset, least = model.value
        net = Network(parameters=parameters)

        def listed(b, spans):
            if not b.isascii():      # bytes to code points
                a = np.frombuffer(b, np.uint8)
                at = np.concatenate([[0], np.cumsum((a & 0xC0) != 0x80)])
                spans = [(at[s], k, at[e]) for s, k, e in spans]
            return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

        for batch in (s for b in batches for s in slices(b)):
            rows = []
            for b in batch.column("text").cast(pa.binary()).to_pylist():
                b = b or b""
                base = base_spans(b)
                free = candidates(b, base)
                if base:
                    free = [(s, e) for s, e in free if not any(x < e and s < y for x, _, y in base)]
                each = [windows(s, e) for s, e in free]
                some = [w for ws in each for w in ws]
                z = [net.forward(views(b, some[k:k + 512])) for k in range(0, len(some), 512)]
                p = _sigmoid(slope * highest(np.concatenate(z), np.array([len(ws) for ws in each])) + offset) if z else []
                more = [(s, 3, e) for (s, e), v in zip(free, p) if v >= least]
                rows.append((sum(k == 0 for _, k, _ in base), sum(k == 1 for _, k, _ in base), sum(k == 2 for _, k, _ in base),
                             hashlib.sha256(listed(b, base).encode()).hexdigest(), listed(b, sorted(base + more)), len(more)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(list(c), t) for c, t in zip(cols, kinds)],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"])

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
