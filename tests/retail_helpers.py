"""What several test modules share. The name is unique: every folder of tests may have its own conftest."""

SMALL = "/root/testdata/sf0.001"


def rows(df, *columns):
    """Collected rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
