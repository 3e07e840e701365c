import random
import zlib
from hashlib import sha256

from cuenca.llm import ctph as K
from cuenca.llm.common import byte_table

NUMBERS = byte_table("ctph")


def plain_print(text: bytes) -> str:
    h, ends = 0, []                     # (end, bits) of every byte
    for k, c in enumerate(text):
        h = ((h << 4) + int(NUMBERS[c])) & 0xFFFFFFFF
        ends.append((k + 1, 32 - ((h * 0x9E3779B1) & 0xFFFFFFFF).bit_length()))

    def signature(k):
        at = [0] + [e for e, bits in ends if bits >= k and e < len(text)] + [len(text)]
        return "".join(K.ALPHABET[zlib.crc32(text[a:b]) & 63] for a, b in zip(at, at[1:]) if b > a)

    k = 2
    while len(signature(k)) > 64:
        k += 1
    return f"{1 << k}:{signature(k)}:{signature(k + 1)}"


def plain_alike(a, b):
    if not a or not b or a == b:
        return float(a == b and a != "")
    w = min(4, len(a), len(b))
    if not any(a[k:k + w] in b for k in range(len(a) - w + 1)):
        return 0.0
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            before, d[j] = d[j], before if x == y else 1 + min(d[j], d[j - 1])
    return 1 - d[-1] / (len(a) + len(b))


def plain_likeness(x, y):
    if x == y:
        return 1.0
    (i, a, a2), (j, b, b2) = x.split(":"), y.split(":")
    pairs = {1: [(a, b), (a2, b2)], 2: [(a2, b)], .5: [(a, b2)]}.get(int(j) / int(i), [])
    return max((plain_alike(*p) for p in pairs), default=0.0)


def texts(seed=1, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghé日") for _ in range(rng.randint(1, 8)))
    out = [None, "", "a", "ab", "abc", "a" * 3000, "ab" * 2000, "\x00" * 500, "é" * 999]
    while len(out) < n:
        out.append(" ".join(word() for _ in range(rng.choice([1, 5, 40, 300]))))
        if rng.random() < .3:
            out.append(out[-1])          # a copy
        if rng.random() < .3:
            out.append(out[-1].replace("ab", "ba", 2))
    return out


def want(rows):
    rows = [(d, t or "") for d, t in rows]
    out = []
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        f, g = plain_print(t.encode()), plain_print(e.encode())
        out.append((d, len(t), sha256(e.encode()).hexdigest(), f, g, plain_likeness(f, g), plain_likeness(f, plain_print(nxt.encode()))))
    return out


def same(got, expected):
    got, expected = sorted(map(tuple, got), key=repr), sorted(expected, key=repr)
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert all(abs(a - b) < 1e-12 for x, y in zip(got, expected) for a, b in zip(x[5:], y[5:]))


def test_equals_plain(spark):
    rows = list(enumerate(texts()))
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    docs = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(6)
    got = K.edited(docs).collect()
    same(got, want(rows))
    by = dict(rows)
    prints = {}
    for r in got:
        assert prints.setdefault(by[r["doc_id"]] or "", r["fingerprint"]) == r["fingerprint"]


def test_long_texts_in_pieces():
    rng = random.Random(4)
    data = [bytes(rng.choice(b"abcdef \n") for _ in range(n)) for n in (10, 999, 1000, 1001, 5000)]
    from cuenca.llm import common
    whole = common.rolling_marks(data, NUMBERS, 4, lambda h: h < 1 << 30)
    pieces = common.rolling_marks(data, NUMBERS, 4, lambda h: h < 1 << 30, block=100)
    assert [a.tolist() for a, _ in whole] == [a.tolist() for a, _ in pieces]
    assert K.fingerprints(data, NUMBERS) == [plain_print(d) for d in data]


def test_edits_are_near_and_other_texts_are_not():
    rng = random.Random(9)
    text = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(400))
    for _ in range(30):
        a, b = text(), text()
        half = a[:len(a) // 2] + b[:len(a) // 2]
        f, g, o = K.fingerprints([x.encode() for x in (a, half, b)], NUMBERS)
        assert K.likeness(f, g) > 0.3 and K.likeness(f, o) < 0.25 and K.likeness(f, f) == 1


def test_one_row_ties_nulls_empty_table_extra_columns(spark):
    schema = "doc_id long, text string, fingerprint string, part int"
    one = spark.createDataFrame([(3, "abc def", "x", 1)], schema)
    same(K.edited(one).collect(), want([(3, "abc def")]))
    assert K.edited(one.limit(0)).collect() == []
    docs = spark.createDataFrame([(None, "n", None, 0), (7, "s", "x", 0), (7, "s", "x", 0), (7, None, "x", 0)], schema)
    got = K.edited(docs).collect()
    assert len(got) == 4 and sorted(r["n_chars"] for r in got) == [0, 1, 1, 1]
