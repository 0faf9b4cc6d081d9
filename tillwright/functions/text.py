"""Text clean-up and natural keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a mail address ends, and the separators of keys and addresses.
MAIL_ENDING = ".com"
KEY_SEPARATOR = "-"
ADDRESS_SEPARATOR = "/"
ADDRESS_FIELDS = ("address", "city", "state", "postal_code")


def mail_address(text: Column) -> Column:
    """Cut a mail address behind its first ``.com`` and make it end there.

    An address without ``.com`` gets it appended; NULL stays NULL.
    """
    return F.concat(F.substring_index(text, MAIL_ENDING, 1), F.lit(MAIL_ENDING))


def address_field(address: Column, field: str) -> Column:
    """One field of a shipping address, NULL where the address is too short."""
    return F.get(F.split(address, ADDRESS_SEPARATOR), F.lit(ADDRESS_FIELDS.index(field)))


def natural_key(*parts: Column) -> Column:
    """Join parts to a text key; NULL parts are left out, all NULL gives ``''``."""
    return F.concat_ws(KEY_SEPARATOR, *parts)
