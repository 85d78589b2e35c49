"""Order-insensitive comparison of a Spark result and a DuckDB result."""

import math


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted((tuple(_cell(r[k]) for k in order) for r in rows), key=repr)


def assert_same(df, con, sql):
    got_names, got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_names, want = normal([c[0] for c in cur.description], cur.fetchall())
    assert got_names == want_names
    assert len(got) == len(want)
    different = [(g, w) for g, w in zip(got, want, strict=True) if repr(g) != repr(w)]
    assert not different, different[:3]
