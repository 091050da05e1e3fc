"""Property tests: native expressions equal their Python definitions."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from fareflow.functions import columns as C

base_nums = st.lists(
    st.one_of(st.none(), st.integers(0, 10**7).map(lambda n: f"B{n:05d}"),
              st.text(alphabet="Bx9", min_size=1, max_size=4)),
    min_size=1, max_size=200)


def expected_base_id(v):
    digits = (v or "")[1:]
    if not digits.isdigit():
        return None
    n = int(digits)
    return ["e/", "a/", "s/"][2 if n % 7 == 0 else n % 3 == 0] + f"{n:03x}"


@settings(max_examples=15, deadline=None)
@given(base_nums)
def test_base_id_native_equals_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "b string")
    got = [r[0] for r in df.select(C.base_id("b")).collect()]
    assert got == [expected_base_id(v) for v in values]


money = st.lists(st.integers(-10**9, 10**9).map(lambda c: Decimal(c) / 100), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(money)
def test_exact_avg_equals_decimal_half_up(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = df.agg(C.exact_avg("x", 4)).first()[0]
    mean = sum(values) / len(values)
    q = abs(mean).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    want = float(q if mean >= 0 else -q)
    assert got == want
