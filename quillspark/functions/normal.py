"""The normal distribution function as an SQL expression.

Neither Spark SQL nor most databases have ``erf``; the published rational
approximations of Cody (1969) reach double precision with the four operations
and ``exp``, so one expression text serves every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Cody's approximations of erf (small arguments)
# and erfc (middle and large arguments), numerator then denominator.
SMALL_NUM = [
    1.85777706184603153e-1, 3.16112374387056560e00, 1.13864154151050156e02,
    3.77485237685302021e02, 3.20937758913846947e03,
]
SMALL_DEN = [
    1.0, 2.36012909523441209e01, 2.44024637934444173e02,
    1.28261652607737228e03, 2.84423683343917062e03,
]
MIDDLE_NUM = [
    2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e00,
    6.61191906371416295e01, 2.98635138197400131e02, 8.81952221241769090e02,
    1.71204761263407058e03, 2.05107837782607147e03, 1.23033935479799725e03,
]
MIDDLE_DEN = [
    1.0, 1.57449261107098347e01, 1.17693950891312499e02, 5.37181101862009858e02,
    1.62138957456669019e03, 3.29079923573345963e03, 4.36261909014324716e03,
    3.43936767414372164e03, 1.23033935480374942e03,
]
LARGE_NUM = [
    1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1,
    1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4,
]
LARGE_DEN = [
    1.0, 2.56852019228982242e00, 1.87295284992346725e00,
    5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3,
]
INV_SQRT_PI = 5.6418958354775628695e-1
SQRT_HALF = 0.70710678118654752440


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _horner(coefficients: list[float], x: str) -> str:
    text = _number(coefficients[0])
    for value in coefficients[1:]:
        text = f"({text} * {x} + {_number(value)})"
    return text


def normal_cdf_sql(z: str) -> str:
    """SQL text of the standard normal distribution function at the expression ``z``."""
    y = f"(abs({z}) * {_number(SQRT_HALF)})"
    small = f"{y} * {_horner(SMALL_NUM, f'({y} * {y})')} / {_horner(SMALL_DEN, f'({y} * {y})')}"
    middle = f"exp(-({y} * {y})) * {_horner(MIDDLE_NUM, y)} / {_horner(MIDDLE_DEN, y)}"
    inv = f"(1 / ({y} * {y}))"
    large = (
        f"exp(-({y} * {y})) / {y} * ({_number(INV_SQRT_PI)} - "
        f"{inv} * {_horner(LARGE_NUM, inv)} / {_horner(LARGE_DEN, inv)})"
    )
    upper_tail = (
        f"CASE WHEN {y} <= 0.46875 THEN 0.5 - 0.5 * ({small}) "
        f"WHEN {y} <= 4 THEN 0.5 * ({middle}) ELSE 0.5 * ({large}) END"
    )
    return f"CASE WHEN {z} > 0 THEN 1 - ({upper_tail}) ELSE {upper_tail} END"


def normal_cdf(name: str) -> Column:
    """Distribution function of a named column of z-scores."""
    return F.expr(normal_cdf_sql(f"`{name}`"))
