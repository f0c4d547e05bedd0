"""Sums of doubles that are exact over the whole range of doubles, so that they do not depend on the order of rows.

A double is an integer times a power of two. Values are split into such integers, for powers that are multiples of 32: bins.
The integers of a bin are added as decimals, which is mergeable and never rounds. The few bins of a group are folded at the
end: carries turn them into digits of 32 bits, and the leading digits are rounded once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobgauge.functions.numbers import finite_number

#: Bits between bins, those of a double's integer, and those of the lower one of its two halves.
BIN_BITS = 32
_MANTISSA = 53
_LOW_BITS = 40
_WIDE = "decimal(38,0)"
#: Bins of numbers of usual size, from 2^-75 to 2^117.
_USUAL_BINS = range(-4, 2)
#: Digits above the highest bin that its sum may reach into.
_CARRY_DIGITS = 4
#: Bins from the lowest one that a decimal can hold, and lowest bins, up or down, whose doubles are far from the ends of the range.
_NEAR_BINS = 3
_NEAR_LIMIT = 16

#: A partial aggregate, and the one that merges its results.
Merged = tuple[Column, Callable[[str], Column]]


def _power(exponent: Column | int) -> Column:
    return F.pow(F.lit(2.0), exponent)


def _scaled(value: Column, exponent: Column) -> Column:
    """value * 2 ** exponent in two steps, as the factor alone may be out of range."""
    half = F.floor(exponent / 2)
    return value * _power(half) * _power(exponent - half)


def exact_parts(value: Column) -> Column:
    """bin, high and low of a double: value = (high * 2^40 + low) * 2^(32 * bin), with integers; NULL where not finite.

    Numbers of usual size take a branch with constants; for the others, logarithm and powers are bound to variables.
    """
    number = value.try_cast("double")
    size = F.abs(number)
    parts = F.when(number == 0, _parts(F.lit(0), F.lit(0), F.lit(0))).when(size < 2.0 ** (_MANTISSA + BIN_BITS * _USUAL_BINS[0]), _any_parts(value))
    for own_bin in _USUAL_BINS:
        high = F.floor(number * 2.0 ** (-BIN_BITS * own_bin - _LOW_BITS))
        low = number * 2.0 ** (-BIN_BITS * own_bin) - high.cast("double") * 2.0**_LOW_BITS
        parts = parts.when(size < 2.0 ** (_MANTISSA + BIN_BITS * (own_bin + 1)), _parts(F.lit(own_bin), high, low))
    return parts.otherwise(_any_parts(value))


def _parts(own_bin: Column, high: Column, low: Column) -> Column:
    return F.struct(own_bin.cast("int").alias("bin"), high.cast("long").alias("high"), low.cast("long").alias("low"))


def _any_parts(value: Column) -> Column:
    """The parts of a number of any size; the array functions compute each step once."""

    def split(whole: Column, own_bin: Column) -> Column:
        high = F.floor(whole / 2.0**_LOW_BITS)
        return _parts(own_bin, high, whole - high.cast("double") * 2.0**_LOW_BITS)

    def placed(number: Column) -> Column:
        lowest = F.floor(F.log2(F.abs(number))) - _MANTISSA
        own_bin = F.when(number == 0, 0).otherwise(F.floor(lowest / BIN_BITS)).cast("int")
        return F.transform(
            F.array(own_bin), lambda b: F.transform(F.array(_scaled(number, b * -BIN_BITS)), lambda whole: split(whole, b))[0]
        )[0]

    number = finite_number(value)
    return F.when(number.isNotNull(), F.transform(F.array(number), placed)[0])


def _digits(entries: Column, first: Column, last: Column) -> Column:
    """The sum of the entries in digits of 32 bits from bin `first` on, and what is left above: negative below zero."""

    def add(state: Column, position: Column) -> Column:
        own = F.aggregate(
            F.filter(entries, lambda e: e["bin"] == position), state["carry"], lambda total, e: (total + _integer(e)).cast(_WIDE)
        )
        return F.transform(
            F.array(own),
            lambda total: F.struct(
                ((total - F.pmod(total, F.lit(2**BIN_BITS))) / 2**BIN_BITS).cast(_WIDE).alias("carry"),
                F.concat(state["digits"], F.array(F.pmod(total, F.lit(2**BIN_BITS)).cast(_WIDE))).alias("digits"),
            ),
        )[0]

    nothing = F.struct(F.lit(0).cast(_WIDE).alias("carry"), F.array().cast(f"array<{_WIDE}>").alias("digits"))
    return F.aggregate(F.sequence(first, last + _CARRY_DIGITS), nothing, add)


def _integer(entry: Column | Mapping[str, Column]) -> Column:
    return (entry["high"].cast(_WIDE) * F.lit(2**_LOW_BITS) + entry["low"]).cast(_WIDE)


def _rounded(digits: Column, first: Column) -> Column:
    """The double next to the digits, ties to even."""
    top = F.array_max(F.transform(digits, lambda d, i: F.when(d > 0, i).otherwise(-1)))

    def of(place: Column) -> Column:
        at = lambda i: F.coalesce(F.get(digits, i), F.lit(0)).cast(_WIDE)
        lead = ((at(place) * 2**BIN_BITS + at(place - 1)).cast(_WIDE) * 2**BIN_BITS + at(place - 2)).cast(_WIDE)
        rest = F.exists(F.slice(digits, 1, F.greatest(place - 2, F.lit(0))), lambda d: d > 0)
        odd = (lead * 2 + rest.cast("int")).cast(_WIDE)
        return _scaled(odd.cast("double"), (first + place - 2) * BIN_BITS - 1)

    return F.transform(F.array(top), lambda place: F.when(place < 0, F.lit(0.0)).otherwise(of(place)))[0]


def folded(entries: Column) -> Column:
    """The sum of an array of bin, high and low as a double; NULL for an empty array, infinite beyond the range of doubles.

    Bins that are near each other are added as one decimal, where it holds them; digits are for the others.
    """
    first = F.array_min(F.transform(entries, lambda e: e["bin"]))

    def add(total: Column, entry: Column) -> Column:
        return F.try_add(total, _shifted(_integer(entry), entry["bin"] - first)).cast(_WIDE)

    near = F.aggregate(entries, F.lit(0).cast(_WIDE), add)
    return F.coalesce(_near_double(near, first), _folded_digits(entries))


def _shifted(integer: Column, bins: Column) -> Column:
    """`integer` times 2^(32 * bins), NULL where a decimal cannot hold it; any number of bins for 0."""
    factor = F.when(bins == 0, F.lit(Decimal(1)))
    for count in range(1, _NEAR_BINS + 1):
        factor = factor.when(bins == count, F.lit(Decimal(2 ** (BIN_BITS * count))))
    return F.when(integer == 0, F.lit(0).cast(_WIDE)).otherwise(F.try_multiply(integer, factor.cast(_WIDE)).cast(_WIDE))


def _near_double(total: Column, first: Column) -> Column:
    """The double next to total * 2^(32 * first): the cast rounds once, the power of two does not, away from the ends of the range."""
    return F.when(F.abs(first) <= _NEAR_LIMIT, total.cast("double") * _power(first * BIN_BITS))


def _folded_digits(entries: Column) -> Column:
    first = F.array_min(F.transform(entries, lambda e: e["bin"]))
    last = F.array_max(F.transform(entries, lambda e: e["bin"]))
    negated = F.transform(
        entries, lambda e: F.struct(e["bin"].alias("bin"), (-e["high"]).alias("high"), (-e["low"]).alias("low"))
    )
    return F.transform(
        F.array(_digits(entries, first, last)),
        lambda sum_: F.when(sum_["carry"] < 0, -_rounded(_digits(negated, first, last)["digits"], first)).otherwise(
            _rounded(sum_["digits"], first)
        ),
    )[0]


def exact_partials(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], others: Mapping[str, Merged] = {}) -> DataFrame:
    """One row per `keys` and bins of the values to sum: a partial aggregate that `exact_totals` merges."""
    split = df.withColumns({f"_{name}_parts": exact_parts(value) for name, value in sums.items()})
    bins = [F.col(f"_{name}_parts.bin").alias(f"_{name}_bin") for name in sums]
    parts = [
        F.sum(F.col(f"_{name}_parts.{half}").cast("decimal(18,0)")).alias(f"_{name}_{half}") for name in sums for half in ("high", "low")
    ]
    counts = [F.count(f"_{name}_parts").alias(f"_{name}_count") for name in sums]
    return split.groupBy(*keys, *bins).agg(*parts, *counts, *[part.alias(name) for name, (part, _) in others.items()])


def exact_totals(partials: DataFrame, keys: Sequence[str], sums: Sequence[str], others: Mapping[str, Merged] = {}) -> DataFrame:
    """One row per `keys`: each sum as a double (NULL without values), `<name>_count` of its values, and the others merged.

    A group has 70 bins at most, whatever its size.
    """
    totals = []
    for name in sums:
        entry = F.struct(F.col(f"_{name}_bin").alias("bin"), F.col(f"_{name}_high").alias("high"), F.col(f"_{name}_low").alias("low"))
        entries = F.collect_list(F.when(F.col(f"_{name}_bin").isNotNull(), entry))
        totals += [F.when(F.sum(f"_{name}_count") > 0, folded(entries)).alias(name), F.sum(f"_{name}_count").alias(f"{name}_count")]
    return partials.groupBy(*keys).agg(*totals, *[merge(name).alias(name) for name, (_, merge) in others.items()])


def exact_aggregate(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], others: Mapping[str, Merged] = {}) -> DataFrame:
    """Exact sums and other mergeable aggregates by `keys`; a second, small shuffle brings the bins of a group together."""
    return exact_totals(exact_partials(df, keys, sums, others), keys, list(sums), others)


def present_bins(df: DataFrame, parts: str) -> list[int]:
    """The bins in a column of `exact_parts`: 70 numbers at most."""
    bins = df.select(F.col(parts)["bin"].alias("bin")).filter("bin IS NOT NULL").distinct()
    return sorted(row.bin for row in bins.collect())


def bin_columns(parts: str, bins: Sequence[int]) -> dict[str, Column]:
    """A column for each half in each bin of a column of `exact_parts`, NULL in other bins, and `_value` to count values by."""
    own = F.col(parts)
    halves = {
        f"_{half}_{i}": F.when(own["bin"] == number, own[half]).cast("decimal(18,0)")
        for i, number in enumerate(bins)
        for half in ("high", "low")
    }
    return halves | {"_value": F.when(own.isNotNull(), 1)}


def folded_columns(bins: Sequence[int], sums: Callable[[str], Column]) -> Column:
    """The double that the sums of `bin_columns`, given by name, stand for; NULL where they hold no value."""
    if not bins:
        return F.lit(None).cast("double")

    def half(name: str, i: int) -> Column:
        return F.coalesce(sums(f"_{name}_{i}"), F.lit(0)).cast(_WIDE)

    entries = [F.struct(F.lit(own).alias("bin"), half("high", i).alias("high"), half("low", i).alias("low")) for i, own in enumerate(bins)]
    near = F.lit(0).cast(_WIDE)
    for i, own in enumerate(bins):
        near = F.try_add(near, _shifted(_integer({"high": half("high", i), "low": half("low", i)}), F.lit(own - bins[0]))).cast(_WIDE)
    total = F.coalesce(_near_double(near, F.lit(bins[0])), _folded_digits(F.array(*entries)))
    return F.when(sums("_value") > 0, total)
