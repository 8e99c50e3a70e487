"""The inverse of the normal distribution function as a column expression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients, highest power first, of the three rational approximations of algorithm AS 241 (Wichura 1988):
# numerator and denominator near the middle, in the tails, and far out in the tails.
MIDDLE = (
    [2509.0809287301227, 33430.57558358813, 67265.7709270087, 45921.95393154987, 13731.69376550946, 1971.5909503065513, 133.14166789178438, 3.3871328727963665],
    [5226.495278852854, 28729.085735721943, 39307.89580009271, 21213.794301586597, 5394.196021424751, 687.1870074920579, 42.31333070160091, 1.0],
)
TAIL = (
    [0.0007745450142783414, 0.022723844989269184, 0.2417807251774506, 1.2704582524523684, 3.6478483247632045, 5.769497221460691, 4.630337846156546, 1.4234371107496835],
    [1.0507500716444169e-09, 0.0005475938084995345, 0.015198666563616457, 0.14810397642748008, 0.6897673349851, 1.6763848301838038, 2.053191626637759, 1.0],
)
FAR_TAIL = (
    [2.0103343992922881e-07, 2.7115555687434876e-05, 0.0012426609473880784, 0.026532189526576124, 0.29656057182850487, 1.7848265399172913, 5.463784911164114, 6.657904643501103],
    [2.0442631033899397e-15, 1.421511758316446e-07, 1.8463183175100548e-05, 0.0007868691311456133, 0.014875361290850615, 0.1369298809227358, 0.599832206555888, 1.0],
)
MIDDLE_REACH, MIDDLE_SHIFT, TAIL_SHIFT, FAR = 0.425, 0.180625, 1.6, 5.0


def _polynomial(coefficients: list[float], x: Column) -> Column:
    return reduce(lambda sum_, c: sum_ * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def inverse_normal(p: Column) -> Column:
    """The value below which a standard normal variable lies with probability ``p``; missing outside 0 < p < 1."""
    q = p - 0.5
    ratio = lambda both, x: _polynomial(both[0], x) / _polynomial(both[1], x)
    middle = q * ratio(MIDDLE, F.lit(MIDDLE_SHIFT) - q * q)
    depth = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(depth <= FAR, ratio(TAIL, depth - TAIL_SHIFT)).otherwise(ratio(FAR_TAIL, depth - FAR))
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= MIDDLE_REACH, middle).otherwise(F.signum(q) * tail))


def inverse_normal_sql(p: str) -> str:
    """The same as SQL text."""
    horner = lambda cs, x: reduce(lambda s, c: f"({s} * {x} + {c!r}::DOUBLE)", cs[1:], f"{cs[0]!r}::DOUBLE")
    ratio = lambda both, x: f"{horner(both[0], x)} / {horner(both[1], x)}"
    depth = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"CASE WHEN {depth} <= {FAR} THEN {ratio(TAIL, f'({depth} - {TAIL_SHIFT})')} ELSE {ratio(FAR_TAIL, f'({depth} - {FAR})')} END"
    middle = f"({p} - 0.5) * {ratio(MIDDLE, f'({MIDDLE_SHIFT} - ({p} - 0.5) * ({p} - 0.5))')}"
    return f"CASE WHEN abs({p} - 0.5) <= {MIDDLE_REACH} THEN {middle} ELSE sign({p} - 0.5) * {tail} END"
