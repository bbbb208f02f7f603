import pytest

from tests import reference_suite as RS


@pytest.fixture(scope="module")
def fx(spark):
    return RS.layers(spark)


@pytest.mark.parametrize("case", RS.CASES, ids=[c.__name__ for c in RS.CASES])
def test_reference_case(spark, fx, case):
    case(spark, fx)


def test_sixteen_cases():
    assert len(RS.CASES) == 16
