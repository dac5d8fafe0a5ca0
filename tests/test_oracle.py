"""Every core query against its SQL, on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import pytest

from palimpsest.plans import registry

DATA = Path("/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, name):
    import duckdb

    df = registry.queries()[name](spark, str(DATA))
    cols = sorted(df.columns)
    got = Counter(repr([plain(r[c]) for c in cols]) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    out = con.execute(sql)
    names = [c[0] for c in out.description]
    assert sorted(names) == cols
    assert got == Counter(repr([plain(r[names.index(c)]) for c in cols]) for r in out.fetchall())
