"""Statistical formulas as Spark column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Double-precision normal tail, numerator and denominator (West 2005).
TAIL_NUM = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
            112.079291497871, 221.213596169931, 220.206867912376)
TAIL_DEN = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
            296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)

# Normal quantile, Wichura's algorithm AS 241, lowest power first.
QUANTILE_MID = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3),
)
QUANTILE_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9),
)
QUANTILE_FAR = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15),
)


def num(x: float) -> Column:
    return F.lit(float(x))


def poly(x: Column, coefs: Sequence[float]) -> Column:
    """Polynomial by Horner's rule, lowest power first."""
    out = num(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = out * x + num(c)
    return out


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero (also under ANSI mode)."""
    return a / F.when(b != 0, b)


# The frame-level helpers below stage their argument as a column first: a column
# expression is a tree, and a polynomial would repeat its argument at every power.

def add_normal_tail(df: DataFrame, z: Column, out: str, upper: bool = False) -> DataFrame:
    """Adds P(N(0,1) > |z|), or P(N(0,1) > z) with ``upper``."""
    staged = df.withColumn("_z", z).withColumn("_x", F.abs("_z"))
    x = F.col("_x")
    frac = x + num(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        frac = x + num(k) / frac
    tail = F.when(x > 37, num(0.0)).otherwise(F.exp(-x * x / 2) * F.when(
        x < 7.07106781186547, poly(x, TAIL_NUM[::-1]) / poly(x, TAIL_DEN[::-1])
    ).otherwise(num(1.0) / (frac * num(2.506628274631))))
    staged = staged.withColumn("_t", tail)
    value = F.when(F.col("_z") >= 0, F.col("_t")).otherwise(1 - F.col("_t")) if upper else F.col("_t")
    return staged.withColumn(out, value).drop("_z", "_x", "_t")


def add_normal_quantile(df: DataFrame, p: Column, out: str) -> DataFrame:
    staged = df.withColumn("_p", p).withColumn("_q", F.col("_p") - num(0.5)).withColumn(
        "_s", num(0.180625) - F.col("_q") * F.col("_q")).withColumn(
        "_r", F.sqrt(-F.log(F.least(F.col("_p"), num(1.0) - F.col("_p")))))
    q, s, r = F.col("_q"), F.col("_s"), F.col("_r")
    mid = q * poly(s, QUANTILE_MID[0]) / poly(s, QUANTILE_MID[1])
    tail = poly(r - num(1.6), QUANTILE_TAIL[0]) / poly(r - num(1.6), QUANTILE_TAIL[1])
    far = poly(r - num(5.0), QUANTILE_FAR[0]) / poly(r - num(5.0), QUANTILE_FAR[1])
    side = F.when(q < 0, num(-1.0)).otherwise(num(1.0))
    return staged.withColumn(out, F.when(F.abs(q) <= 0.425, mid).otherwise(
        side * F.when(r <= 5, tail).otherwise(far))).drop("_p", "_q", "_s", "_r")


def sample_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness from the population skewness."""
    n = n.cast("double")
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, num(0.0)))


def sample_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis from the population excess kurtosis."""
    n = n.cast("double")
    return F.when(
        n > 3,
        (n - 1) / F.nullif((n - 2) * (n - 3), num(0.0)) * ((n + 1) * g2 + 6))


def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson power transform for a given lambda."""
    if abs(lam) < 1e-12:
        pos = F.log1p(x)
    else:
        pos = (F.pow(x + 1, num(lam)) - 1) / num(lam)
    if abs(lam - 2) < 1e-12:
        neg = -F.log1p(-x)
    else:
        neg = -(F.pow(1 - x, num(2 - lam)) - 1) / num(2 - lam)
    return F.when(x >= 0, pos).otherwise(neg)


def clean(x: Column) -> Column:
    """NaN as null, so that NaN never wins a comparison."""
    return F.nanvl(x.cast("double"), F.lit(None).cast("double"))

