"""Helpers of the tests."""


def rows(df, *cols):
    """Collected rows as tuples, sorted (None first)."""
    sel = df.select(*cols) if cols else df
    out = [tuple(r) for r in sel.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))
