"""Cleaning of ids and labels found in payment-processor reports."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def transaction_id(reference: Column) -> Column:
    """Numeric id out of ``005928639`` or ``TXN_5928639``; NULL when the text is not a number.

    ``_`` is a wildcard in LIKE, so any character may follow ``TXN``. The decimal step rounds
    fractional text the way a number cast of the report text does.
    """
    text = F.when(reference.like("TXN_%"), F.substring(reference, 5, 1 << 30)).otherwise(reference)
    return text.try_cast("decimal(38,0)").try_cast("bigint")


def card_network(name: Column) -> Column:
    """Lower case without blanks; the whole value ``mc`` becomes ``mastercard``."""
    squeezed = F.replace(F.lower(name), F.lit(" "), F.lit(""))
    return F.when(squeezed == "mc", F.lit("mastercard")).otherwise(squeezed)


def unquoted_id(text: Column) -> Column:
    """Drop the single quotes some spreadsheet exports put in front of an id."""
    return F.regexp_replace(text.cast("string"), "^'+", "")


def merchant_label(name: Column, merchant_id: Column) -> Column:
    """``NAME - ID`` in capitals, with the company suffix and the separators made uniform."""
    label = F.concat(name, F.lit(" - "), merchant_id)
    # fixed values: replaced text, in order
    for old, new in (("Inc", "LLC"), (", ", " "), ("  ", " ")):
        label = F.replace(label, F.lit(old), F.lit(new))
    return F.upper(label)


def joined(*columns: Column) -> Column:
    """Values as text joined by ``-``."""
    return F.concat_ws("-", *[c.cast("string") for c in columns])


def digits_in(name: str) -> int:
    """All digits of a column name as one number: ``ltv_12mo`` -> 12."""
    return int(re.sub(r"\D", "", name))


def record_id(*parts: Column | str) -> Column:
    """SHA-256 over the parts joined by a vertical bar."""
    columns = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws("|", *columns), 256)
