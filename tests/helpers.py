"""Comparison of results without order."""


def rows(df, *cols):
    """Sorted rows of a data frame as tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=lambda t: [(x is not None, x if x is not None else 0) for x in t])


def table(df):
    """Columns and rows of a pandas frame, as a query and its SQL are compared."""
    df = df[sorted(df.columns)]
    cell = lambda v: "null" if v is None or v != v else repr(round(v, 9)) if isinstance(v, float) else str(v)
    return list(df.columns), sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False, name=None))
