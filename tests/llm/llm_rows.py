def rows(df, *cols):
    """Rows as a sorted list, for comparison."""
    return sorted((tuple(r) for r in df.select(*cols or df.columns).collect()), key=repr)
