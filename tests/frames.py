"""Comparing results."""

import numpy as np


def same_rows(a, b):
    """Whether two pandas frames have the same columns and rows, in any order; doubles to within 1e-6."""
    assert sorted(a.columns) == sorted(b.columns)
    assert len(a) == len(b)
    columns = sorted(a.columns)
    exact = [c for c in columns if a[c].dtype.kind != "f" and b[c].dtype.kind != "f"]
    loose = [c for c in columns if c not in exact]

    def ordered(df):
        keyed = df[columns].copy()
        for c in exact:
            keyed[c] = keyed[c].astype(str)
        for c in loose:
            keyed[c] = keyed[c].astype(float).round(5) + 0.0
        at = keyed.sort_values(exact + loose).index
        return keyed.loc[at].reset_index(drop=True), df.loc[at].reset_index(drop=True)

    (x, raw_x), (y, raw_y) = ordered(a.reset_index(drop=True)), ordered(b.reset_index(drop=True))
    for c in exact:
        assert (x[c] == y[c]).all(), c
    for c in loose:
        assert np.allclose(raw_x[c].astype(float), raw_y[c].astype(float), atol=2e-6, equal_nan=True), c
    return True
