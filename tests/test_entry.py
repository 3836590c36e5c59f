import re


def test_driver_contract(spark):
    import __spark_entry__ as E
    from logweave.plans import QUERIES

    q, o = E.queries(), E.oracle_sql()
    assert len(QUERIES) >= 140 and set(QUERIES) <= set(q) and set(o) <= set(q)
    # Only the library's own names here; numbered operators and the pipeline come on top.
    assert all(re.match(r"op\d+_|pipeline$", name) for name in set(q) - set(QUERIES))
    for name, fn in q.items():
        assert re.fullmatch(r"[a-z][a-z0-9_]*", name)
        assert name not in QUERIES or not re.match(r"op\d+_|pipeline$", name)
        assert (fn.__doc__ or "").strip(), f"{name} has no docstring"
    df = E.entry(spark)
    assert df.columns[0] == "FileID" and df.count() > 0
