"""Device identity and KPI columns of an advertising log row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Identity columns by precedence.
ID_KINDS = ("imei", "mac", "idfa", "openudid", "androidid")
ID_COLUMNS = [f"{k}{suffix}" for suffix in ("md5", "sha1", "") for k in ID_KINDS]
KPI_COLUMNS = ("requests", "effective_requests", "ad_requests", "bids", "wins", "payment", "cost",
               "shows", "clicks")


def has_id() -> Column:
    """True when any device identity is filled."""
    return reduce(lambda a, b: a | b,
                  [F.coalesce(F.col(c) != "", F.lit(False)) for c in ID_COLUMNS])


def _labelled() -> list[Column]:
    return [F.when(F.col(c) != "", F.concat(F.lit(f"{c}:"), F.col(c))) for c in ID_COLUMNS]


def primary_id() -> Column:
    """First filled identity with its kind, hashed forms first; NULL without any."""
    return F.coalesce(*_labelled())


def all_ids() -> Column:
    return F.filter(F.array(*_labelled()), lambda c: c.isNotNull())


def kpi_columns() -> list[Column]:
    """Nine per-row measures to be summed over any grouping."""
    is_ = lambda c, v=1: F.col(c) == v
    one = lambda cond, v=1.0: F.when(cond, v if isinstance(v, Column) else F.lit(v)).otherwise(
        F.lit(0.0))
    request = is_("requestmode")
    billed = is_("iseffective") & is_("isbilling")
    bid = billed & is_("isbid") & (F.col("adorderid") != 0)
    # a row that bids counts as a bid only, even when it also won
    win = billed & is_("iswin") & ~bid
    values = (one(request & F.col("processnode").isin(1, 2, 3)),
              one(request & F.col("processnode").isin(2, 3)),
              one(request & is_("processnode", 3)),
              one(bid), one(win), one(win, F.col("adpayment") / 1000),
              one(win, F.col("winprice") / 1000),
              one(is_("requestmode", 2) & is_("iseffective")),
              one(is_("requestmode", 3) & is_("iseffective")))
    return [v.alias(n) for v, n in zip(values, KPI_COLUMNS)]
