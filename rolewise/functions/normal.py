"""Normal quantiles as an expression, the same text for Spark and other SQL engines."""

from __future__ import annotations

# Wichura's algorithm AS 241 (PPND16), highest power first; numerator and denominator for the middle, the
# flanks and the tails.
TERMS = (
    ((2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4,
      1.3731693765509461125e+4, 1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0),
     (5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4,
      5.3941960214247511077e+3, 6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0)),
    ((7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0,
      3.64784832476320460504e+0, 5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0),
     (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
      6.89767334985100004550e-1, 1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0)),
    ((2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
      2.96560571828504891230e-1, 1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0),
     (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
      1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0)),
)


def _poly(terms: tuple, r: str) -> str:
    out = f"{terms[0]!r}e0" if "e" not in repr(terms[0]) else repr(terms[0])
    for t in terms[1:]:
        out = f"({out} * {r} + {t!r}{'' if 'e' in repr(t) else 'e0'})"
    return out


def normal_quantile_sql(p: str) -> str:
    """SQL text for the normal quantile of the column or expression p in (0, 1)."""
    middle, flank, tail = TERMS
    side = f"(CASE WHEN {p} < 0.5e0 THEN -1e0 ELSE 1e0 END)"
    far = f"sqrt(-ln(CASE WHEN {p} < 0.5e0 THEN {p} ELSE 1e0 - {p} END))"
    ratio = lambda terms, r: f"({_poly(terms[0], r)} / {_poly(terms[1], r)})"
    return (f"(CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * {ratio(middle, f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))')} "
            f"WHEN {far} <= 5e0 THEN {side} * {ratio(flank, f'({far} - 1.6e0)')} ELSE {side} * {ratio(tail, f'({far} - 5e0)')} END)")
