"""Distribution functions as column expressions (and the same in SQL for the oracles)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Wichura's algorithm AS 241 (PPND16, 1988), lowest power first, numerator and
# denominator: for |p - 1/2| <= 0.425, for the tails up to sqrt(-log p) = 5, and beyond.
CENTRAL = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
FAR_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def _ratio(r: Column, coefficients: tuple[Sequence[float], Sequence[float]]) -> Column:
    """Quotient of two polynomials, by Horner's rule."""
    parts = []
    for c in coefficients:
        value = F.lit(float(c[-1]))
        for a in reversed(c[:-1]):
            value = value * r + F.lit(float(a))
        parts.append(value)
    return parts[0] / parts[1]


def inverse_normal(p: Column) -> Column:
    """Quantile of the standard normal distribution, to about 16 digits; NULL outside (0, 1)."""
    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    far = F.when(tail <= 5, _ratio(tail - 1.6, TAIL)).otherwise(_ratio(tail - 5.0, FAR_TAIL))
    value = F.when(F.abs(q) <= 0.425, q * _ratio(0.180625 - q * q, CENTRAL)).otherwise(F.signum(q) * far)
    return F.when((p > 0) & (p < 1), value)


def inverse_normal_sql(p: str) -> str:
    """The same as a SQL expression over ``p`` strictly between 0 and 1."""

    def ratio(r, coefficients):
        num, den = (" + ".join(f"{a!r}::DOUBLE * power({r}, {i})" for i, a in enumerate(c)) for c in coefficients)
        return f"(({num}) / ({den}))"

    q, tail = f"(({p}) - 0.5)", f"sqrt(-ln(least(({p}), 1 - ({p}))))"
    return (f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(f'(0.180625 - {q} * {q})', CENTRAL)} "
            f"WHEN {tail} <= 5 THEN sign({q}) * {ratio(f'({tail} - 1.6)', TAIL)} "
            f"ELSE sign({q}) * {ratio(f'({tail} - 5)', FAR_TAIL)} END")
