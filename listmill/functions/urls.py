"""Hosts and domains of addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Second labels under which names are registered in two-letter domains.
SECOND = ("com", "co", "org", "net", "edu", "gov", "ac")


def host(url: Column) -> Column:
    """Lower-case host without port and leading www."""
    found = F.nullif(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))
    return F.regexp_replace(found, r"^www\.", "")


def domain(url: Column) -> Column:
    """The registered part of the host: its last two labels, or three under a two-letter domain with a second label that is a kind."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    three = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, F.when(n >= 2, -2).otherwise(-1)).isin(*SECOND)
    return F.array_join(F.slice(labels, F.greatest(F.lit(1), n - F.when(three, 2).otherwise(1)), 3), ".")
