"""What several test modules share."""


def rows(df, *names):
    """Rows as sorted tuples."""
    names = names or df.columns
    return sorted((tuple(r[n] for n in names) for r in df.collect()),
                  key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))
