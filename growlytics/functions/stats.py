"""Normal and chi-square distribution functions as Column expressions.

Spark has no ``erf``; these stay JVM-side (no UDF) and work on any column:

- ``erfc``: for |x| < 2.5 the series erf(x) = 2/sqrt(pi) exp(-x^2)
  sum_n 2^n x^(2n+1) / (2n+1)!! (80 terms); above, the continued fraction
  erfc(x) = exp(-x^2) / sqrt(pi) / (x + (1/2) / (x + (2/2) / (x + ...)))
  evaluated backward from level 60; erfc(-x) = 2 - erfc(x).
- ``norm_cdf``, ``norm_two_sided_p`` from erfc.
- ``norm_ppf``: rational first guess (Acklam's coefficients) refined by one
  Halley step against ``norm_cdf``, accurate to ~1e-15.
- ``chi2_sf`` for integer degrees of freedom in closed form (finite sums).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SQRT2 = math.sqrt(2.0)
SQRT_PI = math.sqrt(math.pi)
SQRT_2PI = math.sqrt(2.0 * math.pi)

# Acklam's rational approximation of the normal quantile.
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
      1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
      6.680131188771972e01, -1.328068155288572e01)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
      -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
      3.754408661907416e00)
_P_LOW = 0.02425


def _as_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Column helpers that use their argument several times would otherwise
    copy the whole argument expression at every use; nested helpers then
    grow the tree exponentially (and planning time with it)."""
    return F.transform(F.array(value), body)[0]


def _erf_series(a: Column, terms: int = 80) -> Column:
    """erf(a) for 0 <= a < 2.5."""
    a2 = a * a
    acc = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.struct(a.alias("t"), a.alias("s")),
        lambda st, n: F.struct(
            (st["t"] * 2 * a2 / (2 * n + 1)).alias("t"),
            (st["s"] + st["t"] * 2 * a2 / (2 * n + 1)).alias("s"),
        ),
    )
    return F.lit(2.0 / SQRT_PI) * F.exp(-a2) * acc["s"]


def _erfc_cf(a: Column, depth: int = 60) -> Column:
    """erfc(a) for a >= 2.5 by the backward continued fraction."""
    f = F.aggregate(F.sequence(F.lit(depth), F.lit(1), F.lit(-1)), a, lambda acc, k: a + (k / 2.0) / acc)
    return F.exp(-(a * a)) / (F.lit(SQRT_PI) * f)


def erfc(x) -> Column:
    def body(x: Column) -> Column:
        def tail(a: Column) -> Column:
            return F.when(a < 2.5, 1.0 - _erf_series(a)).otherwise(_erfc_cf(a))

        pos = let(F.abs(x), tail)
        return F.when(x.isNull(), None).when(x < 0, 2.0 - pos).otherwise(pos)

    return let(_as_col(x).cast("double"), body)


def norm_cdf(x) -> Column:
    return 0.5 * erfc(-_as_col(x) / SQRT2)


def norm_two_sided_p(z) -> Column:
    """2 * (1 - Phi(|z|)), computed from the upper tail (no cancellation)."""
    return erfc(F.abs(_as_col(z)) / SQRT2)


def _poly(coefs, x: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * x + c
    return acc


def _ppf_lower(p: Column) -> Column:
    """Initial quantile guess for 0 < p <= 0.5."""
    q = F.sqrt(-2.0 * F.log(p))
    tail = _poly(_C, q) / (_poly(_D, q) * q + 1.0)
    r0 = p - 0.5
    r = r0 * r0
    central = _poly(_A, r) * r0 / (_poly(_B, r) * r + 1.0)
    return F.when(p < _P_LOW, tail).otherwise(central)


def norm_ppf(p) -> Column:
    """Inverse standard normal CDF (NULL outside (0, 1))."""

    def body(p: Column) -> Column:
        def refine(lower: Column) -> Column:
            def halley(x0: Column) -> Column:
                e = 0.5 * erfc(-x0 / SQRT2) - lower
                return let(
                    e * SQRT_2PI * F.exp(x0 * x0 / 2.0),
                    lambda u: x0 - u / (1.0 + x0 * u / 2.0),
                )

            return let(_ppf_lower(lower), halley)

        x1 = let(F.least(p, 1.0 - p), refine)
        return F.when((p <= 0) | (p >= 1) | p.isNull(), None).when(p > 0.5, -x1).otherwise(x1)

    return let(_as_col(p).cast("double"), body)


def chi2_sf(x, df) -> Column:
    """Upper tail of the chi-square distribution with integer ``df`` >= 1
    (df = 0 gives 1, the degenerate table case)."""
    return let(
        _as_col(x).cast("double"),
        lambda xv: let(_as_col(df).cast("int"), lambda dv: _chi2_sf(xv, dv)),
    )


def _chi2_sf(x: Column, df: Column) -> Column:
    h = x / 2.0
    half = (df / 2).cast("int")

    def terms(first: Column, n: Column, step) -> Column:
        seq = F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        acc = F.aggregate(
            seq,
            F.struct(F.lit(0.0).alias("t"), F.lit(0.0).alias("s")),
            lambda st, j: F.struct(
                F.when(j == 1, first).otherwise(st["t"] * h / step(j)).alias("t"),
                (st["s"] + F.when(j == 1, first).otherwise(st["t"] * h / step(j))).alias("s"),
            ),
        )
        return acc["s"]

    # even df: exp(-h) * sum_{j=0}^{df/2-1} h^j / j!
    even = F.exp(-h) * (1.0 + terms(h, half - 1, lambda j: j))
    # odd df: erfc(sqrt(h)) + exp(-h) * sum_{j=1}^{(df-1)/2} h^(j-1/2) / Gamma(j+1/2)
    odd = erfc(F.sqrt(h)) + F.exp(-h) * terms(2.0 * F.sqrt(h / math.pi), half, lambda j: j - 0.5)
    return (
        F.when(x.isNull() | df.isNull(), None)
        .when(df <= 0, 1.0)
        .when(x <= 0, 1.0)
        .when(df % 2 == 0, even)
        .otherwise(odd)
    )


# ---------------------------------------------------------------------------
# The same functions as SQL expression text.  Building a Column tree from
# Python costs one JVM round trip per node; a SQL string is parsed in one
# call, which matters for these deep expressions (series, continued
# fraction, Halley step).  Arguments are SQL expressions over input columns.
# ---------------------------------------------------------------------------

_ids = __import__("itertools").count()


def _name(prefix: str) -> str:
    return f"{prefix}_{next(_ids)}"


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def let_sql(value: str, body) -> str:
    v = _name("v")
    return f"transform(array({value}), {v} -> {body(v)})[0]"


def erfc_sql(x: str, terms: int = 80, depth: int = 60) -> str:
    def tail(a: str) -> str:
        st, n, acc, k = _name("st"), _name("n"), _name("acc"), _name("k")
        step = f"{st}.t * 2D * {a} * {a} / (2 * {n} + 1)"
        series = (
            f"{_d(2.0 / SQRT_PI)} * exp(-{a} * {a}) * aggregate(sequence(1, {terms}), "
            f"named_struct('t', {a}, 's', {a}), ({st}, {n}) -> named_struct('t', {step}, 's', {st}.s + {step})).s"
        )
        cf = (
            f"exp(-{a} * {a}) / ({_d(SQRT_PI)} * aggregate(sequence({depth}, 1, -1), {a}, "
            f"({acc}, {k}) -> {a} + ({k} / 2D) / {acc}))"
        )
        return f"CASE WHEN {a} < 2.5D THEN 1D - {series} ELSE {cf} END"

    def body(xv: str) -> str:
        return let_sql(
            let_sql(f"abs({xv})", tail),
            lambda pv: f"CASE WHEN {xv} IS NULL THEN NULL WHEN {xv} < 0 THEN 2D - {pv} ELSE {pv} END",
        )

    return let_sql(f"CAST({x} AS DOUBLE)", body)


def norm_two_sided_p_sql(z: str) -> str:
    return erfc_sql(f"abs({z}) / {_d(SQRT2)}")


def _poly_sql(coefs, x: str) -> str:
    acc = _d(coefs[0])
    for c in coefs[1:]:
        acc = f"({acc} * {x} + {_d(c)})"
    return acc


def norm_ppf_sql(p: str) -> str:
    def body(pv: str) -> str:
        def refine(lo: str) -> str:
            def guess(q: str) -> str:
                return f"{_poly_sql(_C, q)} / ({_poly_sql(_D, q)} * {q} + 1D)"

            def central(r0: str) -> str:
                return let_sql(f"{r0} * {r0}", lambda r: f"{_poly_sql(_A, r)} * {r0} / ({_poly_sql(_B, r)} * {r} + 1D)")

            x0 = (
                f"CASE WHEN {lo} < {_d(_P_LOW)} THEN {let_sql(f'sqrt(-2D * ln({lo}))', guess)} "
                f"ELSE {let_sql(f'{lo} - 0.5D', central)} END"
            )

            def halley(x: str) -> str:
                e = f"(0.5D * {erfc_sql(f'-{x} / {_d(SQRT2)}')} - {lo})"
                return let_sql(f"{e} * {_d(SQRT_2PI)} * exp({x} * {x} / 2D)", lambda u: f"{x} - {u} / (1D + {x} * {u} / 2D)")

            return let_sql(x0, halley)

        x1 = let_sql(f"least({pv}, 1D - {pv})", refine)
        return f"CASE WHEN {pv} IS NULL OR {pv} <= 0 OR {pv} >= 1 THEN NULL WHEN {pv} > 0.5D THEN -{x1} ELSE {x1} END"

    return let_sql(f"CAST({p} AS DOUBLE)", body)


def chi2_sf_sql(x: str, df: str) -> str:
    def body(xv: str, dv: str) -> str:
        h = f"({xv} / 2D)"
        half = f"CAST({dv} / 2 AS INT)"

        def terms(first: str, n: str, step) -> str:
            st, j = _name("st"), _name("j")
            nxt = f"CASE WHEN {j} = 1 THEN {first} ELSE {st}.t * {h} / {step(j)} END"
            seq = f"CASE WHEN {n} >= 1 THEN sequence(1, {n}) ELSE CAST(array() AS ARRAY<INT>) END"
            return (f"aggregate({seq}, named_struct('t', 0D, 's', 0D), "
                    f"({st}, {j}) -> named_struct('t', {nxt}, 's', {st}.s + {nxt})).s")

        even = f"exp(-{h}) * (1D + {terms(h, f'{half} - 1', lambda j: j)})"
        odd = (f"{erfc_sql(f'sqrt({h})')} + exp(-{h}) * "
               f"{terms(f'2D * sqrt({h} / {_d(math.pi)})', half, lambda j: f'({j} - 0.5D)')}")
        return (f"CASE WHEN {xv} IS NULL OR {dv} IS NULL THEN NULL WHEN {dv} <= 0 THEN 1D WHEN {xv} <= 0 THEN 1D "
                f"WHEN {dv} % 2 = 0 THEN {even} ELSE {odd} END")

    return let_sql(f"CAST({x} AS DOUBLE)", lambda xv: let_sql(f"CAST({df} AS INT)", lambda dv: body(xv, dv)))
