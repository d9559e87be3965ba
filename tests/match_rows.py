"""Results of queries as comparable rows. Not in conftest: a second conftest of a subfolder would hide it."""


def rows(df, *order):
    """Result as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(x is not None, str(x)) for x in t])
