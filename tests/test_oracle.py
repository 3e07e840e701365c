"""Every registered query with an oracle: Spark result == DuckDB result on
the smallest driver tables (row count, column names and types, and the
order-insensitive multiset of values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from oracle_check import exact_spark, family_duck, family_spark, multiset  # noqa: E402

from cuenca.plans.registry import load_all  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

REG = load_all()
WITH_SQL = sorted(k for k, e in REG.items() if e.sql)


@pytest.mark.parametrize("key", WITH_SQL)
def test_query_matches_oracle(spark, duck, key):
    e = REG[key]
    df = e.build(spark, SF_SMALL)
    srows, scols = df.collect(), df.columns
    sfam = [family_spark(f.dataType) for f in df.schema.fields]
    cur = duck.execute(e.sql)
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    dfam = [family_duck(str(d[1])) for d in cur.description]
    assert sorted(scols) == sorted(dcols)
    os_ = sorted(range(len(scols)), key=lambda i: scols[i])
    od = sorted(range(len(dcols)), key=lambda i: dcols[i])
    assert [sfam[i] for i in os_] == [dfam[i] for i in od]
    sexact = [exact_spark(f.dataType) for f in df.schema.fields]
    dexact = [str(d[1]).upper() for d in cur.description]
    assert [sexact[i] for i in os_] == [dexact[i] for i in od]
    assert len(srows) == len(drows)
    assert multiset(srows, os_, True) == multiset(drows, od, True)


def test_every_query_has_an_oracle():
    assert [k for k, e in REG.items() if e.sql is None] == []
