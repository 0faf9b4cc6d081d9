"""Raw groups to clean, typed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions import mail_address, try_date

# Misspelt source columns and their names in the warehouse.
SPELLING = {"cusomter_lname": "customer_lname", "cusomter_email": "customer_email"}


def clean_sales(raw: DataFrame) -> DataFrame:
    """Spell columns right, repair mail addresses, cast the transaction date.

    Columns that a projection left out are skipped.
    """
    spelt = raw.withColumnsRenamed(SPELLING)
    cleaners = {"customer_email": mail_address, "transaction_date": try_date}
    return spelt.withColumns({name: clean(F.col(name)) for name, clean in cleaners.items() if name in spelt.columns})


def with_date(raw: DataFrame, column: str) -> DataFrame:
    return raw.withColumn(column, try_date(F.col(column)))


def date_rejects(raw: DataFrame, column: str) -> DataFrame:
    """Raw rows whose date text is not a date.  They load with a NULL date as well."""
    return raw.where(F.col(column).isNotNull() & try_date(F.col(column)).isNull())
