"""Job parameters.

Every value that the original job read from the wall clock or hard-coded in a
config module is a parameter here, so a run is reproducible.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    # years added to every source date (yyyymmdd keys and timestamps)
    shift_years: int = 24
    # calendar dimension range, inclusive
    calendar_start: str = "2019-02-01"
    calendar_end: str = "2030-12-31"
    # "today" for the future-date rules, as a yyyymmdd key
    as_of_key: int = 20250630
    # batch identifiers written into facts and the audit log
    batch_id: str = "AW_FULL_LOAD_DATE_SHIFTED"
    batch_ts: str = "2025-06-30 12:00:00"
    # the batch id names one batch of rows: loading it again (a replay) changes nothing.  False: an id may
    # be used for many loads, and each is loaded and recorded by itself
    once: bool = False
    # started / completed time of the batch's ledger rows; None = the wall clock of the load
    batch_clock: str | None = None
    # constant manufacturer written into dim_drug
    manufacturer: str = "Generic Pharma Ltd"
    # source_system tag of the batch sales fact
    source_system: str = "AW_INTERNET"
    # source_system tag of uploaded sales
    upload_source_system: str = "DAILY_UPLOAD"
    # first source key given to customers created by uploads is max(existing, floor) + 1
    new_customer_key_floor: int = 99999
    # characters of an upload's customer name that are matched, that a new customer's name
    # keeps, and that its type keeps; None = all (a cut lets names with one prefix collapse)
    customer_match_chars: int | None = None
    customer_name_chars: int | None = None
    customer_type_chars: int | None = None
    extra: dict = field(default_factory=dict)

    @property
    def as_of_date(self) -> dt.date:
        k = self.as_of_key
        return dt.date(k // 10000, (k // 100) % 100, k % 100)

    @property
    def calendar_days(self) -> int:
        s = dt.date.fromisoformat(self.calendar_start)
        e = dt.date.fromisoformat(self.calendar_end)
        return (e - s).days + 1

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT = Params()
