"""Helpers shared by the tests of the library proper."""


def rows(df, *cols):
    cols = cols or df.columns

    def key(t):
        return tuple((True, 0) if v is None else (False, v) for v in t)

    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key)
