"""Helpers of the tests, under a name that no other folder's conftest can shadow."""

SF_SMOKE = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Selected columns as a sorted list of tuples."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
