"""Helpers of the tests, in a module whose name no other test folder has."""


def rows(df, *columns):
    """Rows as tuples, in a fixed order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(type(v)), v) for v in t))
