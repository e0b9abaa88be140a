"""Distribution functions.

The column versions are rational approximations built from ordinary expressions, for use
on whole tables. The plain-Python versions serve single result rows (a p-value per test).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

# Hart's rational approximation of the normal distribution function.
HART_NUMERATOR = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
HART_DENOMINATOR = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]
HART_SWITCH = 7.07106781186547

# Wichura's algorithm AS 241 for the normal quantile (numerator, denominator).
AS241_CENTRE = (
    [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457,
     13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.387132872796366608],
    [5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867,
     5394.1960214247511077, 687.1870074920579083, 42.313330701600911252, 1.0],
)
AS241_MIDDLE = (
    [7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177,
     1.27045825245236838258, 3.64784832476320460504, 5.7694972214606914055, 4.6303378461565452959,
     1.42343711074968357734],
    [1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966,
     0.14810397642748007459, 0.68976733498510000455, 1.6763848301838038494,
     2.05319162663775882187, 1.0],
)
AS241_TAIL = (
    [2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386,
     0.026532189526576123093, 0.29656057182850489123, 1.7848265399172913358,
     5.4637849111641143699, 6.6579046435011037772],
    [2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5,
     7.868691311456132591e-4, 0.0148753612908506148525, 0.13692988092273580531,
     0.59983220655588793769, 1.0],
)


def horner(coefficients, x):
    """Polynomial with the highest power first; works for columns, arrays and numbers."""
    value = coefficients[0]
    for c in coefficients[1:]:
        value = x * value + c
    return value


def normal_cdf(x: Column) -> Column:
    a = F.abs(x)
    bell = F.exp(-a * a / F.lit(2.0))
    near = bell * horner(HART_NUMERATOR, a) / horner(HART_DENOMINATOR, a)
    chain = a + F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        chain = a + F.lit(k) / chain
    far = bell / chain / F.lit(2.506628274631)
    lower = F.when(a > 37, F.lit(0.0)).when(a < HART_SWITCH, near).otherwise(far)
    return F.when(x > 0, F.lit(1.0) - lower).otherwise(lower)


def normal_ppf(p: Column) -> Column:
    """Normal quantile for 0 < p < 1."""
    q = p - F.lit(0.5)
    r = F.lit(0.180625) - q * q
    centre = q * horner(AS241_CENTRE[0], r) / horner(AS241_CENTRE[1], r)
    root = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    middle = root - F.lit(1.6)
    tail = root - F.lit(5.0)
    outer = F.when(
        root <= 5, horner(AS241_MIDDLE[0], middle) / horner(AS241_MIDDLE[1], middle)
    ).otherwise(horner(AS241_TAIL[0], tail) / horner(AS241_TAIL[1], tail))
    return F.when(F.abs(q) <= 0.425, centre).when(q < 0, -outer).otherwise(outer)


def normal_ppf_array(p: np.ndarray) -> np.ndarray:
    """The same for the few thousand normal scores of one test."""
    q = p - 0.5
    r = 0.180625 - q * q
    centre = q * horner(AS241_CENTRE[0], r) / horner(AS241_CENTRE[1], r)
    root = np.sqrt(-np.log(np.minimum(p, 1.0 - p)))
    outer = np.where(
        root <= 5,
        horner(AS241_MIDDLE[0], root - 1.6) / horner(AS241_MIDDLE[1], root - 1.6),
        horner(AS241_TAIL[0], root - 5.0) / horner(AS241_TAIL[1], root - 5.0),
    )
    return np.where(np.abs(q) <= 0.425, centre, np.sign(q) * outer)


def lilliefors_p(d: Column, n: Column) -> Column:
    """p-value of D when mean and deviation were estimated (Dallal and Wilkinson 1986).

    Above 0.1 the polynomials fitted to Stephens' modified statistic apply.
    """
    n = n.cast("double")
    dk = F.when(n <= 100, d).otherwise(d * F.pow(n / 100.0, F.lit(0.49)))
    nk = F.least(n, F.lit(100.0))
    small = F.exp(
        F.lit(-7.01256) * dk * dk * (nk + 2.78019)
        + F.lit(2.99587) * dk * F.sqrt(nk + 2.78019)
        - 0.122119 + F.lit(0.974598) / F.sqrt(nk) + F.lit(1.67997) / nk
    )
    k = (F.sqrt(n) - 0.01 + F.lit(0.85) / F.sqrt(n)) * d
    # Stephens' polynomials, highest power first, by upper end of k.
    large = (
        F.when(k <= 0.302, F.lit(1.0))
        .when(k <= 0.5, horner([81.218052, -138.55152, 80.709644, -19.828315, 2.76773], k))
        .when(k <= 0.9, horner([-32.355711, 94.029866, -97.490286, 40.662806, -4.901232], k))
        .when(k <= 1.31, horner([2.423045, -12.234627, 23.186922, -19.558097, 6.198765], k))
        .otherwise(F.lit(0.0))
    )
    return F.when(small > 0.1, large).otherwise(small)


# --- single result rows -----------------------------------------------------------------


def normal_upper_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def t_two_sided(t: float | None, df: float | None) -> float | None:
    """Two-sided p of Student's t: the regularised incomplete beta at df/(df+t^2)."""
    if t is None or df is None or df <= 0 or math.isnan(t):
        return None
    if math.isinf(t):
        return 0.0
    return _beta_regularized(df / 2.0, 0.5, df / (df + t * t))


def _beta_regularized(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta, evaluated by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 10_000):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-16:
            break
    return value


def ks_two_sided(d: float | None, n: int | None) -> float | None:
    """p of the two-sided statistic against a fully known distribution.

    Up to 10,000 rows the finite-sample law is used: twice the one-sided tail where the
    statistic is large (there the two tails do not meet), the matrix-power form of
    Marsaglia, Tsang and Wang elsewhere. Beyond, the limiting series.
    """
    if d is None or not n:
        return None
    if n > 10_000:
        return _kolmogorov_series(math.sqrt(n) * d)
    if n * d * d >= 2.2:
        return min(1.0, 2.0 * _one_sided_tail(d, n))
    return max(0.0, 1.0 - _ks_matrix(d, n))


def _kolmogorov_series(x: float) -> float:
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2.0 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2.0 * total))


def _one_sided_tail(d: float, n: int) -> float:
    """Birnbaum and Tingey's sum, term by term in logarithms."""
    logs = []
    for j in range(int(math.floor(n * (1.0 - d))) + 1):
        left, right = d + j / n, 1.0 - d - j / n
        if right <= 0.0:
            continue
        choose = math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
        logs.append(choose + (j - 1) * math.log(left) + (n - j) * math.log(right))
    if not logs:
        return 0.0
    top = max(logs)
    return d * math.exp(top) * math.fsum(math.exp(v - top) for v in logs)


def _ks_matrix(d: float, n: int) -> float:
    """P(D < d) as an entry of the n-th power of a small matrix."""
    k = int(n * d) + 1
    h = k - n * d
    m = 2 * k - 1
    step = np.subtract.outer(np.arange(m), np.arange(m)) + 1
    matrix = np.where(step >= 0, 1.0, 0.0)
    powers = h ** np.arange(1, m + 1)
    matrix[:, 0] -= powers
    matrix[m - 1, :] -= powers[::-1]
    matrix[m - 1, 0] += max(2 * h - 1, 0.0) ** m
    factorial = np.array([math.gamma(s + 1) if 0 <= s < 170 else math.inf for s in range(m + 1)])
    matrix = np.where(step > 0, matrix / factorial[np.clip(step, 0, m)], matrix)
    result, shift = np.eye(m), 0
    base, base_shift, exponent = matrix, 0, n
    while exponent:
        if exponent & 1:
            result, shift = result @ base, shift + base_shift
            result, shift = _rescale(result, shift)
        base, base_shift = _rescale(base @ base, 2 * base_shift)
        exponent >>= 1
    log_value = math.log(max(result[k - 1, k - 1], 1e-300)) + shift * math.log(10.0)
    return math.exp(log_value + math.lgamma(n + 1) - n * math.log(n))


def _rescale(matrix: np.ndarray, shift: int) -> tuple[np.ndarray, int]:
    top = float(np.abs(matrix).max())
    if top > 1e100 or 0 < top < 1e-100:
        power = int(math.floor(math.log10(top)))
        return matrix / 10.0**power, shift + power
    return matrix, shift


# Royston's polynomials for the Shapiro-Wilk test, lowest power first.
SW_LAST = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
SW_LAST_BUT_ONE = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_GAMMA = [-2.273, 0.459]
SW_MEAN_SMALL = [0.544, -0.39978, 0.025054, -6.714e-4]
SW_SD_SMALL = [1.3822, -0.77857, 0.062767, -0.0020322]
SW_MEAN_LARGE = [-1.5861, -0.31082, -0.083751, 0.0038915]
SW_SD_LARGE = [-0.4803, -0.082676, 0.0030302]


def shapiro_weights(n: int) -> np.ndarray:
    """Antisymmetric weights for sorted data (Royston 1995)."""
    if n == 3:
        return np.array([-math.sqrt(0.5), 0.0, math.sqrt(0.5)])
    scores = normal_ppf_array((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    square = float(scores @ scores)
    u = 1.0 / math.sqrt(n)
    unit = scores / math.sqrt(square)
    last = horner(SW_LAST[::-1], u) + unit[-1]
    weights = np.empty(n)
    if n > 5:
        second = horner(SW_LAST_BUT_ONE[::-1], u) + unit[-2]
        rest = (square - 2 * scores[-1] ** 2 - 2 * scores[-2] ** 2) / (
            1.0 - 2 * last**2 - 2 * second**2
        )
        weights[2:-2] = scores[2:-2] / math.sqrt(rest)
        weights[-2], weights[1] = second, -second
    else:
        rest = (square - 2 * scores[-1] ** 2) / (1.0 - 2 * last**2)
        weights[1:-1] = scores[1:-1] / math.sqrt(rest)
    weights[-1], weights[0] = last, -last
    return weights


def shapiro_p(w: float, n: int) -> float:
    if n == 3:
        p = 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))
        return min(1.0, max(0.0, p))
    if w >= 1.0:
        return 1.0
    y = math.log(1.0 - w)
    if n <= 11:
        gamma = horner(SW_GAMMA[::-1], float(n))
        if y >= gamma:
            return 1e-99
        y = -math.log(gamma - y)
        mean = horner(SW_MEAN_SMALL[::-1], float(n))
        sd = math.exp(horner(SW_SD_SMALL[::-1], float(n)))
    else:
        log_n = math.log(n)
        mean = horner(SW_MEAN_LARGE[::-1], log_n)
        sd = math.exp(horner(SW_SD_LARGE[::-1], log_n))
    return normal_upper_tail((y - mean) / sd)


def shapiro(values: np.ndarray) -> tuple[float | None, float | None]:
    """W and p of one sample of 3 to 5,000 values."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3:
        return None, None
    centred = x - x.mean()
    spread = float(centred @ centred)
    if spread == 0.0:
        return 1.0, 1.0
    w = float(shapiro_weights(n) @ x) ** 2 / spread
    w = min(w, 1.0)
    return w, shapiro_p(w, n)



def with_shapiro(sums: DataFrame) -> DataFrame:
    """Add ``w`` and ``p`` to rows of sums over all ranks: ``square`` of the scores,
    ``product`` of score and centred value, and the two smallest (x1, x2) and largest (y2,
    y1) centred values. Missing below three values.

    In steps, because each value is used several times by the next one.
    """
    n, size = F.col("n"), F.col("n").cast("double")
    u, x = F.col("__u"), F.ln(size)
    last, second, a1, a2 = (F.col(f"__{c}") for c in ("last", "second", "a1", "a2"))
    outer, inner, y, gamma = (F.col(f"__{c}") for c in ("outer", "inner", "y", "gamma"))
    root = F.sqrt("square")
    scored = sums.withColumns(
        {
            "__u": F.lit(1.0) / F.sqrt(size),
            "__last": normal_ppf((size - 0.375) / (size + 0.25)),
            "__second": normal_ppf((size - 1.375) / (size + 0.25)),
            "__outer": F.col("y1") - F.col("x1"), "__inner": F.col("y2") - F.col("x2"),
        }
    ).withColumns(
        {
            "__a1": horner(SW_LAST[::-1], u) + last / root,
            "__a2": horner(SW_LAST_BUT_ONE[::-1], u) + second / root,
        }
    )
    square, product = F.col("square"), F.col("product")
    long = a1 * outer + a2 * inner + (product - last * outer - second * inner) / F.sqrt(
        (square - 2 * last * last - 2 * second * second) / (1 - 2 * a1 * a1 - 2 * a2 * a2)
    )
    short = a1 * outer + (product - last * outer) / F.sqrt(
        (square - 2 * last * last) / (1 - 2 * a1 * a1)
    )
    three = F.lit(math.sqrt(0.5)) * outer
    weighted = scored.withColumn(
        "__sum", F.when(n < 3, None).when(n == 3, three).when(n <= 5, short).otherwise(long)
    )
    ratio = F.least(F.col("__sum") * F.col("__sum") / F.nullif("spread", F.lit(0.0)), F.lit(1.0))
    tested = weighted.withColumn("w", F.when(n < 3, None).when(outer == 0, 1.0).otherwise(ratio))
    tested = tested.withColumns(
        {"__y": F.ln(F.nullif(1 - F.col("w"), F.lit(0.0))), "__gamma": horner(SW_GAMMA[::-1], size)}
    )
    small = (-F.ln(F.greatest(gamma - y, F.lit(1e-300))) - horner(SW_MEAN_SMALL[::-1], size)) / F.exp(
        horner(SW_SD_SMALL[::-1], size)
    )
    large = (y - horner(SW_MEAN_LARGE[::-1], x)) / F.exp(horner(SW_SD_LARGE[::-1], x))
    tested = tested.withColumn("__z", F.when(n <= 11, small).otherwise(large))
    w = F.col("w")
    exact = F.lit(6.0 / math.pi) * (F.asin(F.sqrt(w)) - math.asin(math.sqrt(0.75)))
    p = (
        F.when(w.isNull(), None)
        .when(n == 3, F.least(F.greatest(exact, F.lit(0.0)), F.lit(1.0)))
        .when(w >= 1, 1.0)
        .when((n <= 11) & (y >= gamma), 1e-99)
        .otherwise(normal_cdf(-F.col("__z")))
    )
    out = tested.withColumn("p", p)
    return out.drop(*[c for c in out.columns if c.startswith("__")])
