"""What tests compare: the rows of a DataFrame."""


def rows(df, *order):
    """All rows as dicts, sorted."""
    return [r.asDict() for r in df.orderBy(*(order or df.columns)).collect()]
