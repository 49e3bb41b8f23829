"""Helpers that tests import by name."""


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
