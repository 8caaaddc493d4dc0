"""Row expressions: residuals, labels, chi, magnitudes, coordinates, times."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .stats import _col, ratio

# Status bits, magnitude zero points, color terms and locus polynomials.
USED = 1
RESERVED = 2
ZERO_POINT = 31.4
ZERO_POINT_EXACT = 31.400094
FAKE_J_FLUX_OFFSET = 0.054
FAKE_J_MAG_OFFSET = 0.08
NARROW_J = (-0.172811, 0.362018, 0.00223607)
LOCUS = {
    "gri": (-12.74432612, 5.72884386, 1.35199207, 0.12986592),
    "riz": (73.19247901, -5.73469827, 1.42925779, 0.09580749),
    "izy": (88.5481888, -6.46929173, 1.10589459, 0.000633426991),
}


def finite_or_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


# lines and their status

def is_trace(description: Column | str = "description") -> Column:
    return _col(description) == "Trace"


def has_any(status: Column | str, mask: int) -> Column:
    return _col(status).bitwiseAND(F.lit(mask)) != 0


def status_type(status: Column | str) -> Column:
    return F.when(has_any(status, USED), "USED").when(has_any(status, RESERVED), "RESERVED")


def status_name(status: Column | str, names: dict[str, int]) -> Column:
    """Names of the bits that are set, joined with ``|``."""
    parts = [F.when(has_any(status, bit), F.lit(name)) for name, bit in names.items()]
    return F.concat_ws("|", *parts)


def ccd(arm: Column | str = "arm", spectrograph: Column | str = "spectrograph") -> Column:
    return F.concat(_col(arm), _col(spectrograph).cast("string"))


def ccd_arm(name: Column | str) -> Column:
    return F.substring(_col(name), 1, 1)


def ccd_spectrograph(name: Column | str) -> Column:
    return F.substring(_col(name), 2, 1).cast("int")


def bundle_group(bundle: Column | str) -> Column:
    return F.substring(_col(bundle), 1, 6)


def wavelength_key(w: Column | str) -> Column:
    """Two-digit text form of a wavelength, for membership in a line list."""
    return F.format_string("%.2f", _col(w))


def wave_row(w: Column | str) -> Column:
    return _col(w).cast("int")


# chi and image residuals

def usable_sky(flux="flux", sky="sky", variance="variance", mask="mask") -> Column:
    return _col(flux).isNotNull() & (_col(sky) > 0) & (_col(variance) > 0) & (_col(mask) == 0)


def chi(flux="flux", variance="variance", where: Column | None = None) -> Column:
    value = ratio(flux, F.sqrt(_col(variance)))
    return value if where is None else F.when(where, value)


def chi_poisson(flux="flux", sky="sky", where: Column | None = None) -> Column:
    value = ratio(flux, F.sqrt(F.abs(_col(flux) + _col(sky))))
    return value if where is None else F.when(where, value)


def threshold_class(x: Column | str, lo: int = 3, hi: int = 10) -> Column:
    size = F.abs(_col(x))
    return F.when(size < lo, f"< {lo}").when(size > hi, f"> {hi}").when(size.isNotNull(), f"{lo} < x < {hi}")


def range_class(x: Column | str, lo: Column | float, hi: Column | float) -> Column:
    x = _col(x)
    return F.when(x < lo, "under").when(x > hi, "over").when(x.isNotNull(), "inside")


def clamp(x: Column | str, lo: Column | float, hi: Column | float) -> Column:
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(_col(x).isNotNull(), F.least(F.greatest(_col(x), lo), hi))


# magnitudes

def ab_mag(flux: Column | str, zero: float = ZERO_POINT) -> Column:
    f = _col(flux)
    return F.when(f > 0, F.log10(f) * F.lit(-2.5) + F.lit(zero))


def flux_of_mag(mag: Column | str, zero: float = ZERO_POINT) -> Column:
    return F.pow(F.lit(10.0), (_col(mag) - F.lit(zero)) * F.lit(-0.4))


def narrow_j(g: Column | str, r: Column | str, y: Column | str) -> Column:
    c0, c1, c2 = NARROW_J
    gr = _col(g) - _col(r)
    return _col(y) - (F.lit(c0) + F.lit(c1) * gr + F.lit(c2) * gr * gr)


def locus_residual(m1, m2, m3, name: str) -> Column:
    """Distance of color m1-m2 from the stellar sequence at color m2-m3."""
    a, b, c, d = LOCUS[name]
    x = _col(m2) - _col(m3)
    return (_col(m1) - _col(m2)) - (((F.lit(a) * x + F.lit(b)) * x + F.lit(c)) * x + F.lit(d))


def fake_band(fluxes: Column | str, offset: float = FAKE_J_FLUX_OFFSET) -> Column:
    """Flux array with one more element, the last flux minus a fixed offset."""
    f = _col(fluxes)
    return F.concat(f, F.array(F.element_at(f, -1) - F.lit(offset)))


def fake_band_names(names: Column | str, name: str = "fakeJ") -> Column:
    return F.concat(_col(names), F.array(F.lit(name)))


def log10_positive(x: Column | str) -> Column:
    return F.when(_col(x) > 0, F.log10(_col(x)))


# positions and times

def offset(x1, y1, x2, y2) -> Column:
    dx, dy = _col(x1) - _col(x2), _col(y1) - _col(y2)
    return F.sqrt(dx * dx + dy * dy)


def relative_ra(ra, ra0, dec0) -> Column:
    return (_col(ra) - _col(ra0)) * F.cos(F.radians(_col(dec0)))


def relative_dec(dec, dec0) -> Column:
    return _col(dec) - _col(dec0)


def utc_to_hawaii(ts: Column | str) -> Column:
    """Local time of a UTC timestamp as text, one fractional digit, truncated."""
    local = F.from_utc_timestamp(_col(ts).cast("timestamp"), "US/Hawaii")
    return F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.S")


def one_of(column: Column | str, values: Sequence) -> Column:
    return _col(column).isin(list(values))
