"""The library's fixed values against those the oracle states for itself."""

import pytest

from enrolmeter import fixed_values
from oracle import values

NAMES = [name for name in dir(values) if name.isupper()]


def test_both_state_the_same_names():
    assert NAMES == [name for name in dir(fixed_values) if name.isupper()]


@pytest.mark.parametrize("name", NAMES)
def test_equal(name):
    assert getattr(fixed_values, name) == getattr(values, name)
