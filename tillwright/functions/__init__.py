"""Column expressions shared by the operators; all of them stay inside codegen."""

from tillwright.functions.dates import date_id, date_parts, try_date
from tillwright.functions.offers import OFFER_PERCENTAGES, discounted_total, redeemed_offer
from tillwright.functions.text import address_field, mail_address, natural_key

__all__ = [
    "OFFER_PERCENTAGES",
    "address_field",
    "date_id",
    "date_parts",
    "discounted_total",
    "mail_address",
    "natural_key",
    "redeemed_offer",
    "try_date",
]
