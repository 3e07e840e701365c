import pytest

from cuenca.llm import licenses as L

TEXTS = {1: "Licensed under CC BY-NC 4.0.", 2: "x Released under the MIT License. y", 3: "All rights reserved. ALL-RIGHTS,reserved", 4: "rights all reserved license of the public",
         5: "This work is licensed under the GNU General Public License, version 3.", 6: None, 7: "", 8: "Licensed under the Apache License, Version 2.0.",
         9: "the license of Apache was version 2", 10: "nothing at all", 11: "cc by cc by", 12: "ccby CCÉ by"}
WANT = {1: ("cc-by", "cc-by,cc-by-nc", 1, 2), 2: ("", "mit", 0, None), 3: ("reserved", "reserved", 2, 0), 4: ("", "", 0, None), 5: ("gpl", "gpl,gpl-3.0", 1, 7),
        6: ("", "", 0, None), 7: ("", "", 0, None), 8: ("", "apache-2.0", 0, None), 9: ("", "", 0, None), 10: ("", "", 0, None), 11: ("cc-by", None, 2, 0), 12: ("", "", 0, None)}


def test_phrases_templates_and_near_misses(spark):
    filler = [(100 + i, f"the word of number {i} and all that it is under") for i in range(40)]
    df = spark.createDataFrame(list(TEXTS.items()) + filler, "doc_id long, text string")
    got = {r.doc_id: r for r in L.scan(df).collect()}
    for d, (base, labels, n, first) in WANT.items():
        r = got[d]
        assert (r.base_labels, r.n_base, r.first_word) == (base, n, first), d
        if labels is not None:
            assert r.labels == labels, d
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert got[3].last_word == 3 and got[12].n_words == 3
    assert all(got[100 + i].labels == "" for i in range(40))


def test_equals_sql(spark):
    import duckdb
    rows = list(TEXTS.items()) + [(200 + i, f"a {t} b") for i, (_, t, _) in enumerate(L.TEMPLATES)] + [(1, TEXTS[1])]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.sql(L.SQL)
    out = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).select(want.columns).collect()
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want.fetchall()))


def test_every_template_finds_itself(spark):
    rows = [(i, f"some words before. {t}. and after") for i, (_, t, _) in enumerate(L.TEMPLATES)]
    got = {r.doc_id: r.labels.split(",") for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, _, _) in enumerate(L.TEMPLATES):
        assert label in got[i]


def test_every_notice_of_a_joined_file_is_found(spark):
    import random
    rng = random.Random(3)
    files = [L.TEMPLATES] + [rng.sample(L.TEMPLATES, 10) for _ in range(30)]
    rows = [(i, "\n\n".join(f"{t}." for _, t, _ in ts)) for i, ts in enumerate(files)]
    rows += [(100 + i, f"some words before. {t}. and after") for i, (_, t, _) in enumerate(L.TEMPLATES)]
    rows += [(200 + i, f"the word of number {i} and all that it is under") for i in range(40)]
    got = {r.doc_id: set(r.labels.split(",")) for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, ts in enumerate(files):
        assert {label for label, _, _ in ts} <= got[i], i


def test_nulls_repeats_empty(spark):
    rows = [(None, "All rights reserved", "x"), (None, None, "x"), (1, "MIT License released under the mit license", None)] * 2
    out = L.scan(spark.createDataFrame(rows, "doc_id long, text string, labels string")).collect()
    assert len(out) == 6 and sorted(r.labels for r in out) == ["", "", "mit", "mit", "reserved", "reserved"]
    assert L.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("part", ["base", "found"])
def test_no_python_in_the_plan(spark, part):
    df = spark.createDataFrame(list(TEXTS.items()), "doc_id long, text string").cache()
    out = L.scan(df) if part == "base" else L.found(L.short_rows(df), L.index(L.short_rows(df)))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lower_case_is_that_of_ascii(spark):
    """Signs whose lower case is an ASCII letter stay letters of their own."""
    rows = [(1, "MIT LICENSE released under the"), (2, "released under the mİt license"), (3, "K released UNDER the MIT license É"),
            (4, "all rİghts reserved"), (5, "ALL RIGHTS RESERVED K")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.n_base) for r in L.scan(df).collect()}
    assert got[2] == ("", 0) and got[3][0] == "mit" and got[4] == ("", 0) and got[5] == ("reserved", 1)
