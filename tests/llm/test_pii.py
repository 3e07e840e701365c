import hashlib
import re

from cuenca.llm import pii as P

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TEXTS = ["a@b.c%x@d.e", "a.b@c", "x@y.z.w a@b.c@d.e", "1.2.3.4.5.6.7.8", "300.1.1.1 1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111 5555555555554444",
         "+1 (408) 555-7800.", "+49-30-1234567 +1", "é ñ😀 a@b.c 😀 1.1.1.1", None, "", "0" * 20000, "+" * 2000 + "1 2 3", "1 " * 10000, "a" * 30000,
         "@@@a@b", "1.1.1.1@x.y", "00001.002.3.4", "4111111111111112", "12345678901234567890"]


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def plain(t):
    t, out = t or "", []
    out += [(m.start(), 0, m.end()) for m in re.finditer(EMAIL, t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(IP, t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(CARD, t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(PHONE, t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def digest(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def query(spark, monkeypatch, rows, schema="doc_id long, text string"):
    df = spark.createDataFrame(rows, schema)
    monkeypatch.setattr(P, "table", lambda *a: df)
    return P.query(spark, "x").collect()


def test_base_equals_the_plain_rules(spark, monkeypatch):
    rows = list(enumerate(TEXTS))
    for r in query(spark, monkeypatch, rows):
        spans = plain(TEXTS[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for _, x, _ in spans) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(digest(spans).encode()).hexdigest()
        assert r.spans == digest(spans)


def test_patterns_find_unseen_identifiers(spark, monkeypatch):
    rows = [(i, f"w{i} passport: +1 (408) 555-{1000 + i} x{i}") for i in range(8)]
    rows += [(20 + i, f"v{i} passport: QX-{i}1234 y{i}") for i in range(3)]              # found by the pattern of the seeds
    rows += [(30 + i, f"u{i} the +1 (408) 555-{2000 + i} z{i}" + " the word" * 50) for i in range(8)]
    rows += [(40, "the A-12345 is a part number"), (41, "no data here")]                  # a common word is no pattern
    got = {r.doc_id: r.spans for r in query(spark, monkeypatch, rows)}
    assert [got[20 + i] for i in range(3)] == ["context:13:21"] * 3
    assert got[40] == "" and got[41] == "" and got[0].startswith("phone:")


def test_nulls_repeats_clashes_empty(spark, monkeypatch):
    rows = [(None, "a@b.c", 1), (None, None, 1), (1, "a@b.c", 1), (1, "a@b.c", 1)]
    got = query(spark, monkeypatch, rows, "doc_id long, text string, base int")
    assert sorted(r.spans for r in got) == ["", "email:0:5", "email:0:5", "email:0:5"]
    assert query(spark, monkeypatch, [], "doc_id long, text string") == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    plan = P.base_spans(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def plain_context(rows):
    """Accepted candidates {(doc_id, start, stop)} by the graph's rule, step by step."""
    edges, total = set(), {}
    for d, t in rows:
        t = t or ""
        for w in re.split(r"[\x20\x09-\x0D]+", t.lower()):
            total[w] = total.get(w, 0) + 1
        base = plain(t)
        found = [(m.start(), m.end()) for m in re.finditer(r"(?<!\S)[^\s0-9]*[0-9]\S*", t)] + [m.span() for m in re.finditer(P.GROUP, t)]
        cand = [(a, b) for a, b in found if b - a >= 5 and not any(x < b and a < y for x, _, y in base)]
        for a, b, seed in [(x, y, True) for x, _, y in base] + [(a, b, False) for a, b in cand]:
            left = re.search(r"([^\x20\x09-\x0D]+)[\x20\x09-\x0D]+$", t[:a])
            right = re.match(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)", t[b:])
            edges |= {(d, t, a, b, seed, t[a:b], p + m[1].lower()) for p, m in (("L:", left), ("R:", right)) if m}
    values = {}
    for *_, v, p in edges:          # patterns with too few instances never count
        values.setdefault(p, set()).add(v)
    edges = [e for e in edges if len(values[e[6]]) >= P.SUPPORT]
    score = {e: float(e[4]) for e in edges}
    while True:
        pattern = {}
        for p in {e[6] for e in edges}:
            mine = [e for e in edges if e[6] == p]
            share = round(sum(score[e] for e in mine) / total[p[2:]], 9)
            if share >= P.CONFIDENT and len({e[5] for e in mine if score[e] >= P.ACCEPT}) >= P.SUPPORT:
                pattern[p] = min(share, 1.0)
        new = {}
        for e in edges:
            missed = 1.0
            for p in sorted({x[6] for x in edges if x[5] == e[5] and x[6] in pattern}):
                missed *= 1 - pattern[p]
            new[e] = 1.0 if e[4] else 1 - missed
        grown = max((new[e] - score[e] for e in edges), default=0)
        score = new
        if grown < P.SETTLED:
            return {(e[0], e[2], e[3]) for e in edges if not e[4] and score[e] >= P.ACCEPT}


def chain(links):
    """Identifiers that only the pattern of the link before discovers."""
    rows = [(i, f"a{i} mark0: +1 (408) 555-{1000 + i} b{i}") for i in range(6)]
    for k in range(links):
        for i in range(3):              # twice beside the next mark: two thirds of its places are known then
            rows.append((100 * (k + 1) + i, f"c{k}x{i} mark{k}: ID{k}{i}9876 d{k}x{i}"))
            rows += [(100 * (k + 1) + 50 + 10 * n + i, f"e{k}x{i}y{n} mark{k + 1}: ID{k}{i}9876 f{k}x{i}y{n}") for n in (0, 1)]
    return rows


def test_graph_equals_the_plain_version_and_runs_to_its_end(spark, monkeypatch):
    import random
    rng = random.Random(8)
    rows = chain(6)
    rows += [(900 + i, f"g{i} tax: +1 (408) 555-{3000 + i} h{i}") for i in range(5)]
    rows += [(910 + i, f"g{i} tax: QQ 1{i} 34 56 C h{i}") for i in range(3)]                # a group of short pieces
    rows += [(920 + i, f"{'long' * 60}x: +1 (408) 555-{4000 + i}") for i in range(4)] + [(930, f"{'long' * 60}x: XY-99887")]
    for i in range(60):
        word = lambda: rng.choice(["id", "no", "ref", "the", "of"])
        rows.append((1000 + i, " ".join(f"{word()} {rng.choice(['a@b.c' + str(rng.randrange(9)), 'K' + str(rng.randrange(12)) + '5555', word(), '12 34 AB'])}"
                                        for _ in range(6))))
    want = plain_context(rows)
    got = {r.doc_id: r.spans for r in query(spark, monkeypatch, rows)}
    assert {(d, *map(int, s.split(":")[1:])) for d, spans in got.items() for s in spans.split(",") if s.startswith("context")} == want
    assert any(d >= 650 and d < 700 for d, *_ in want)      # the sixth link of the chain
    assert {(910 + i) for i in range(3)} | {930} <= {d for d, *_ in want}
