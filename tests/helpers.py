"""Helpers of the core tests."""


def rows(df, *order):
    """Rows as tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
