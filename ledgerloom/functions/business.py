"""Columns that carry the rules of payment records."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom.functions.mapping import literal_map

# Lower bounds of the amount bands, each band closed on the left.
AMOUNT_BANDS = ((0, "Small"), (50, "Medium"), (200, "Large"), (1000, "Very Large"))


def rate_table(exchange_rates: dict[str, float] | None, target_currency: str) -> dict[str, float]:
    """Rates by upper-case code; a later entry for the same code wins, the target is always 1."""
    rates = {code.upper(): float(rate) for code, rate in (exchange_rates or {}).items()}
    rates.pop(target_currency.upper(), None)
    return rates


def normal_amount(
    amount: Column,
    currency: Column,
    exchange_rates: dict[str, float] | None,
    target_currency: str = "USD",
) -> Column:
    """Amount in the target currency; an unknown currency keeps its amount."""
    rates = rate_table(exchange_rates, target_currency)
    if not rates:
        return amount
    rate = F.try_element_at(literal_map(rates), F.upper(currency))
    return F.coalesce(amount * rate, amount)


def rate_missing(
    currency: Column, exchange_rates: dict[str, float] | None, target_currency: str = "USD"
) -> Column:
    """True where an amount was kept only because no rate is known for its currency."""
    known = [target_currency.upper(), *rate_table(exchange_rates, target_currency)]
    return ~F.coalesce(F.upper(currency).isin(*known), F.lit(False))


def is_international(currency: Column, target_currency: str = "USD") -> Column:
    """True unless the currency is the target; an absent currency counts as foreign."""
    return ~F.upper(currency).eqNullSafe(F.lit(target_currency.upper()))


def is_high_value(amount: Column, threshold: float) -> Column:
    """True where the amount lies above the threshold; null and NaN amounts are not high."""
    return F.coalesce((amount > F.lit(threshold)) & ~F.isnan(amount), F.lit(False))


def amount_band(amount: Column, bands=AMOUNT_BANDS) -> Column:
    """Name of the band an amount falls into; null below the lowest bound."""
    out = None
    for bound, name in reversed(bands):
        hit = (amount >= F.lit(bound)) & ~F.isnan(amount)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def date_parts(c: Column, prefix: str = "Transaction") -> dict[str, Column]:
    """Year, month, day and English weekday name of a date or timestamp."""
    return {
        f"{prefix}Year": F.year(c),
        f"{prefix}Month": F.month(c),
        f"{prefix}Day": F.dayofmonth(c),
        f"{prefix}DayOfWeek": F.date_format(c, "EEEE"),
    }


def raw_timestamp_text(date: Column, time: Column) -> Column:
    """Date and time texts side by side, as the staging files carry them."""
    return F.concat(date, F.lit(" "), time)
