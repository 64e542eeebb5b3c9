"""Scalar column expressions (Column -> Column), all JVM-side built-ins.

pandas semantics that matter here: missing values are NaN and flow through
arithmetic, ``clip`` keeps NaN, comparisons with NaN are False. In Spark the
missing value is NULL, ``greatest/least`` *skip* NULL and comparisons yield
NULL, so every helper below guards NULL explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(x, lo: float | None = None, hi: float | None = None) -> Column:
    """pandas ``clip``: NULL stays NULL."""
    x = col(x)
    out = x
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def safe_div(num, den, default=None) -> Column:
    """``num / den`` with ``default`` (NULL unless given) where ``den == 0``."""
    num, den = col(num), col(den)
    d = F.lit(default).cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(den == 0, d).otherwise(num / den)


def is_true(c) -> Column:
    """Boolean with NULL read as False (pandas comparisons with NaN)."""
    return F.coalesce(col(c), F.lit(False))


def season(month) -> Column:
    m = col(month)
    out = None
    for name, months in C.SEASONS.items():
        if name == "Fall":
            continue
        cond = m.isin(*months)
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    # Everything else (including NULL month) falls to the last season, as the
    # reference's ``else`` branch does.
    return out.otherwise(F.lit("Fall"))


def hour_band(hour) -> Column:
    h = col(hour)
    out = F.when(h.isNull(), F.lit(C.UNKNOWN))
    for name, lo, hi in C.HOUR_BANDS:
        out = out.when(h.between(lo, hi), F.lit(name))
    return out.otherwise(F.lit(C.NIGHT_BAND))


def _lt_bands(x, bands, top) -> Column:
    x = col(x)
    out = F.when(x.isNull() | F.isnan(x), F.lit(C.UNKNOWN))
    for name, upper in bands:
        out = out.when(x < upper, F.lit(name))
    return out.otherwise(F.lit(top))


def load_band(load_factor) -> Column:
    return _lt_bands(load_factor, C.LOAD_BANDS, C.LOAD_BAND_TOP)


def distance_band(km) -> Column:
    return _lt_bands(km, C.DISTANCE_BANDS, C.DISTANCE_BAND_TOP)


def cut_edges(x, edges: list[float], labels: list[str]) -> Column:
    """``pd.cut(x, edges, labels)``: right-closed ``(e_i, e_i+1]``, NULL outside."""
    x = col(x)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def route_part(route, i: int) -> Column:
    """i-th part of ``ORG-DST``; NULL when absent (no ANSI index error)."""
    return F.get(F.split(col(route), "-"), i)


def route_parts(route) -> Column:
    return F.size(F.split(col(route), "-"))


def haversine_km(lat1, lon1, lat2, lon2, radius: float = C.EARTH_RADIUS_KM) -> Column:
    lat1, lon1, lat2, lon2 = map(col, (lat1, lon1, lat2, lon2))
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2 - lat1)
    dlam = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2 * radius) * F.asin(F.sqrt(a))


def type_factor(type_col) -> Column:
    t = col(type_col)
    out = None
    for name, factor in C.TYPE_FACTORS.items():
        out = F.when(t == name, F.lit(factor)) if out is None else out.when(t == name, F.lit(factor))
    return out.otherwise(F.lit(1.0))


def load_factor(pax, capacity) -> Column:
    """pax / capacity clipped to [0, 1]; x/0 behaves like pandas (inf -> 1, 0/0 -> NULL)."""
    pax, cap = col(pax), col(capacity)
    ratio = (
        F.when(cap == 0, F.when(pax > 0, F.lit(1.0)).when(pax < 0, F.lit(0.0)))
        .otherwise(pax.cast("double") / cap)
    )
    return clip(ratio, 0.0, 1.0)


def positive_part(x) -> Column:
    """``x.clip(lower=0)`` with NULL kept."""
    return clip(x, lo=0.0)


def segment_name(cols: list[str]) -> Column:
    """Composite segment label; NULL when any key is NULL (such groups are dropped)."""
    parts = [F.col(c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(C.SEGMENT_SEP))
        pieces.append(p)
    return F.concat(*pieces)


def segment_part(name, i: int) -> Column:
    """Split a composite segment label back into its i-th part."""
    return F.get(F.split(col(name), r" \| "), i)


def month_label(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def fixed_units(x) -> Column:
    """``x`` rounded half up to whole units of 10^-FIXED_PLACES, DECIMAL(19, 0)
    (values up to 9e14); NaN counts as missing."""
    unit = F.lit(float(10**C.FIXED_PLACES))
    units = F.floor(F.nanvl(col(x), F.lit(None).cast("double")) * unit + F.lit(0.5))
    return units.cast("decimal(19,0)")


def from_units(x: Column) -> Column:
    """The DOUBLE that a number of units stands for."""
    return x.cast("double") / F.lit(float(10**C.FIXED_PLACES))


def fixed_sum(x) -> Column:
    """Total of ``x`` in units of 10^-FIXED_PLACES, added up as DECIMAL(29, 0): the
    same for any order of the rows, partitioning and engine, where a sum of DOUBLE
    loses its last digits. NULL and NaN add nothing, no value at all gives NULL."""
    return from_units(F.sum(fixed_units(x)))


def sig_round(x, digits: int = 9) -> Column:
    """Keep ``digits`` significant digits, identically in any IEEE engine.

    Only exact powers of ten are used, and the rounding boundary sits at
    0.4863 of the last kept digit instead of 0.5: averages of decimal data
    often end exactly on a half, where float summation order would decide
    the direction; an off-centre boundary is never hit by such values.
    """
    x = col(x)
    k = sig_exponent(x, digits)
    return sig_rounded(x, k, F.pow(F.lit(10.0), F.abs(k)))


def sig_exponent(x: Column, digits: int = 9) -> Column:
    """Power of ten of the last kept digit."""
    return F.floor(F.log10(F.abs(x))) - F.lit(digits - 1)


def sig_rounded(x: Column, k: Column, unit: Column) -> Column:
    """``x`` in whole steps of ten to the ``k``; ``unit`` is ten to the ``|k|``."""
    back = F.when(k >= 0, F.floor(x / unit + ROUND_SHIFT) * unit).otherwise(F.floor(x * unit + ROUND_SHIFT) / unit)
    return F.when(x.isNull() | (x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), x).otherwise(back)


ROUND_SHIFT = 0.5137
