"""Helpers that the test modules import by name (``conftest`` is not a name
of one module once a subfolder has its own)."""


def rows(df, *cols):
    """Multiset of tuples (sorted list) of the given columns."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
