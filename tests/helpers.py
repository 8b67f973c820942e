"""Helpers that test modules import; fixtures are in conftest.py."""


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
