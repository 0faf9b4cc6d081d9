"""Offer flags to the offer that was redeemed, and the price after it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.functions.text import natural_key

# Discount in percent of each offer flag.
OFFER_PERCENTAGES = {"offer_1": 5, "offer_2": 10, "offer_3": 15, "offer_4": 20, "offer_5": 25}


def _pick(values: dict[str, Column], otherwise: Column) -> Column:
    """The value of the first flag that is set."""
    return F.coalesce(*[F.when(F.col(flag), value) for flag, value in values.items()], otherwise)


def redeemed_offer() -> tuple[Column, Column]:
    """``(offer_id, percentage)`` of a sale.

    Offers do not combine: a sale flagged with two or more redeems none.  A flag that is
    present but false redeems nothing either.
    """
    flags_set = reduce(
        lambda left, right: left + right,
        [F.when(F.col(flag), 1).otherwise(0) for flag in OFFER_PERCENTAGES],
    )
    percentage = F.when(
        flags_set == 1, _pick({flag: F.lit(pct) for flag, pct in OFFER_PERCENTAGES.items()}, F.lit(0))
    ).otherwise(0)
    offer_id = F.when(
        flags_set == 1,
        _pick(
            {flag: natural_key(F.lit(pct), F.lit(flag)) for flag, pct in OFFER_PERCENTAGES.items()},
            F.lit(None).cast("string"),
        ),
    )
    return offer_id, percentage


def discounted_total(units: Column, unit_price: Column, percentage: Column) -> Column:
    """Price paid after the discount, to three places."""
    return F.round(units * unit_price * (1 - percentage / 100), 3)
