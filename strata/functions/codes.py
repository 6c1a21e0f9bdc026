"""Code lists and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The public yellow-taxi data dictionary.
VENDORS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}
RATE_CODES = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/unknown",
}
STORE_FLAGS = {"Y": "Store and forward trip", "N": "Not a store and forward trip"}
PAYMENT_TYPES = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


def decode(column: Column, labels: dict, default: str | None = None) -> Column:
    """Label of a code, ``default`` for an unknown one."""
    result = F.lit(default)
    for code, label in labels.items():
        result = F.when(column == F.lit(code), label).otherwise(result)
    return result
