"""Expressions for the lookup of a category's dataset."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The address of a lookup is base + category id + suffix, and the
# answer is a JSON body with this field.
ADDRESS_SUFFIX = "/ACCOUNTID"
LOCATION_FIELD = "location"


def lookup_address(base: str, category_id: Column) -> Column:
    return F.concat(F.lit(base), category_id, F.lit(ADDRESS_SUFFIX))


def location_of(body: Column, field: str = LOCATION_FIELD) -> Column:
    """The location in a JSON body, whole even if it holds ``:`` or ``,``."""
    return F.get_json_object(body, f"$.{field}")
