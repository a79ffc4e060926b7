"""Browsing limits are kept or refused, never changed."""
import pytest

from flowlens.operators.logs import browse_limit


@pytest.mark.parametrize("n", [1, 5000])
def test_allowed(n):
    assert browse_limit(n) == n


@pytest.mark.parametrize("n", [0, -3, 5001, 100000])
def test_refused(n):
    with pytest.raises(ValueError):
        browse_limit(n)
