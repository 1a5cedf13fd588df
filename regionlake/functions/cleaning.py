"""Cleaning, coding and rounding expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from regionlake import config as C


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def round_half_even(c, digits: int = 0) -> Column:
    """Round a double the way array libraries do: scale, nearest-even, unscale."""
    scale = float(10**digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def finite(c) -> Column:
    """NaN and infinities become null."""
    c = col(c).cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def number(c) -> Column:
    """String to double; a decimal comma is accepted, anything unreadable (or NaN) is null."""
    return F.nullif(F.translate(col(c).cast("string"), ",", ".").try_cast("double"), F.lit(float("nan")))


def first_number(c) -> Column:
    """First run of digits and points of a label such as ``25,3 €/m²``."""
    text = F.translate(col(c).cast("string"), ",", ".")
    return F.nullif(F.regexp_extract(text, r"([\d.]+)", 1), F.lit("")).try_cast("double")


def first_digits(c) -> Column:
    """First run of digits as an integer; null without one."""
    return F.nullif(F.regexp_extract(col(c).cast("string"), r"(\d+)", 1), F.lit("")).try_cast("int")


def last_digits(c) -> Column:
    """One or two digits closing a label, as an integer; null without one."""
    return F.nullif(F.regexp_extract(col(c).cast("string"), r"(\d{1,2})$", 1), F.lit("")).try_cast("int")


def in_domain(c, n_regions: int = C.N_REGIONS) -> Column:
    """The code if it lies in 1..n, else null."""
    c = col(c)
    return F.when(c.between(1, n_regions), c)


def has_prefix(c, prefix: str = C.POSTAL_PREFIX) -> Column:
    """Prefix test as a plain string predicate, which scans can push down.

    A missing code gives null, which a filter drops like false.
    """
    return col(c).startswith(prefix)


def region_of_code(c, prefix: str | None = None, n_regions: int = C.N_REGIONS) -> Column:
    """Region of a five-character postal or commune code: its last two digits."""
    code = col(c).cast("string")
    region = in_domain(F.right(code, F.lit(2)).try_cast("int"), n_regions)
    if prefix is None:
        return region
    return F.when(has_prefix(code, prefix) & (F.length(code) == 5), region)


def region_of_commune(c, base: int = C.COMMUNE_BASE, n_regions: int = C.N_REGIONS) -> Column:
    """Commune number ``base + region`` to region; other communes are null."""
    return in_domain((number(c) - F.lit(base)).try_cast("int"), n_regions)


def region_of_mixed(c, limit: int = 75000, n_regions: int = C.N_REGIONS) -> Column:
    """Either a commune code above ``limit`` (last two digits) or a plain region number."""
    code = col(c).try_cast("int")
    return in_domain(F.when(code > limit, code % 100).otherwise(code), n_regions)


def first_truthy(*cols) -> Column:
    """First value that is neither null, zero nor empty."""

    def keep(c):
        c = col(c)
        text = c.cast("string")
        zero = F.coalesce(text.try_cast("double") == 0.0, F.lit(False))
        return F.when((text != "") & ~zero, c)

    return F.coalesce(*[keep(c) for c in cols])


def first_filled(*cols) -> Column:
    """First string that is neither null nor empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def clip(c, low: float, high: float) -> Column:
    """Clamp to [low, high]; null stays null."""
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(float(high))), F.lit(float(low))))


def in_box(lat, lon, box: C.Box = C.POINT_BOX) -> Column:
    return col(lat).between(box.lat_min, box.lat_max) & col(lon).between(box.lon_min, box.lon_max)


def poi_class(shop, amenity, shops=None, health=None) -> Column:
    """Class of a point of interest: the shop tag first, then the amenity tag."""

    def lookup(table, key):
        pairs = [F.lit(x) for kv in table.items() for x in kv]
        return F.try_element_at(F.create_map(*pairs), F.coalesce(col(key), F.lit("")))

    return F.coalesce(
        lookup(shops or C.SHOP_CLASSES, shop), lookup(health or C.HEALTH_CLASSES, amenity)
    )


def keyword_category(c, rules=C.CATEGORY_KEYWORDS, other: str = C.CATEGORY_OTHER) -> Column:
    """First category one of whose keywords occurs in the lower-cased name."""
    name = F.lower(col(c).cast("string"))
    hits = [
        F.when(reduce(lambda a, b: a | b, [name.contains(k) for k in words]), F.lit(category))
        for category, words in rules
    ]
    return F.coalesce(*hits, F.lit(other))


def truncated(c, n: int) -> Column:
    return F.substring(col(c).cast("string"), 1, n)


def address(*parts) -> Column:
    """Parts joined by a blank, missing parts skipped; null when all are missing."""
    return F.nullif(F.concat_ws(" ", *[col(p).cast("string") for p in parts]), F.lit(""))


def parsed_date(c, fmt: str | None = None) -> Column:
    """Date of an ISO string, or of the given format; unreadable dates are null."""
    if fmt is None:
        return col(c).try_cast("date")
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("date")


def row_sum(*cols) -> Column:
    """Sum of the columns of a row; a missing value counts as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) for c in cols])


def unit_price(value, surface) -> Column:
    return F.try_divide(col(value).cast("double"), col(surface).cast("double"))


def alert_level(c, orange: float = C.ALERT_ORANGE, red: float = C.ALERT_RED) -> Column:
    """Red above ``red``, orange above ``orange``, otherwise null (both strict)."""
    c = col(c)
    return F.when(c > red, F.lit(C.LEVEL_RED)).when(c > orange, F.lit(C.LEVEL_ORANGE))


def min_max_score(c, low, high, inverse: bool = False, neutral: float = 5.0) -> Column:
    """0..10 position of ``c`` between ``low`` and ``high``; a constant column scores neutral."""
    c, low, high = col(c), col(low), col(high)
    position = F.try_divide(c - low, high - low) * F.lit(10.0)
    if inverse:
        position = F.lit(10.0) - position
    return F.when(low == high, F.lit(neutral)).otherwise(position)


def weighted(parts: dict[str, float], names: dict[str, str | Column]) -> Column:
    """Weighted sum of the named score columns, in the order of ``parts``."""
    terms = [col(names[k]) * F.lit(float(w)) for k, w in parts.items()]
    return reduce(lambda a, b: a + b, terms)
