"""Rows of a frame for comparison."""


def rows(df):
    """All rows as tuples, in a fixed order."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
