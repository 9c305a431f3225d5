"""What the test modules share; not named conftest, as every folder of tests may have one of those."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Sorted list of tuples of the chosen columns."""
    cols = cols or df.columns
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
