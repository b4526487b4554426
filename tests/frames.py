"""Comparing frames in tests."""

import math


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def assert_close(found, expected):
    """Equal rows of two frames, floats to one part in a billion."""
    found, expected = rows(found), rows(expected)
    assert len(found) == len(expected)
    for a, b in zip(found, expected):
        assert len(a) == len(b)
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                assert math.isclose(x, y, rel_tol=1e-9), (a, b)
            else:
                assert x == y, (a, b)
