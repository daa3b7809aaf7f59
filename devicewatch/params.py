"""Job parameters and the fixed values the analysis is defined by."""

from __future__ import annotations

import dataclasses
import re
import uuid
from collections.abc import Mapping
from datetime import date, datetime, timezone

# The source never serves more than this many records per page.
MAX_PAGE_RECORDS = 1000

# Default high-risk terms, in reporting order.
HIGH_RISK_KEYWORDS = (
    "death", "died", "fatal", "deceased",
    "severe", "serious injury", "permanent",
    "infection", "sepsis", "contamination",
    "malfunction", "failure", "breakage", "leakage",
    "recall", "field correction",
)

# Patient outcome codes. Every other code, and no code, reads NO_OUTCOME.
OUTCOME_LABELS = {
    "1": "Death",
    "2": "Life Threatening",
    "3": "Hospitalization",
    "4": "Disability",
    "5": "Congenital Anomaly",
    "6": "Required Intervention",
    "7": "Other",
}
NO_OUTCOME = "No Information"

# Lowest adverse-event rate (percent) of each tier, highest tier first.
RISK_TIERS = (("High", 50), ("Medium", 20))
LOWEST_TIER = "Low"


def compact_date(value: str | date) -> str:
    """``2023-01-31``, ``20230131`` or a date as ``20230131``; anything else is refused."""
    if isinstance(value, date):
        return value.strftime("%Y%m%d")
    text = value.strip()
    if not re.fullmatch(r"\d{8}|\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a date: {value!r}")
    return datetime.strptime(text.replace("-", ""), "%Y%m%d").strftime("%Y%m%d")


def new_run_id(prefix: str = "run") -> str:
    """Run id from UTC time plus six random hex digits."""
    return f"{prefix}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def utc_stamp() -> str:
    """Now, as the ISO text used in ``_ingested_at``."""
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"


@dataclasses.dataclass(frozen=True)
class JobParams:
    """What one job run is about. Dates are normalised and values checked on creation."""

    manufacturer: str
    date_from: str
    date_to: str
    # Records the source is asked for per page.
    page_limit: int = MAX_PAGE_RECORDS
    # Records of a landed page file, whatever the size of the source's pages.
    file_records: int = 200_000
    run_id: str = dataclasses.field(default_factory=new_run_id)
    keywords: tuple[str, ...] = HIGH_RISK_KEYWORDS
    # Reports without a report number go to quarantine; False keeps them as one report.
    quarantine_blank: bool = True
    # Devices and narratives of superseded report versions are left out; False keeps them.
    latest_only: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "date_from", compact_date(self.date_from))
        object.__setattr__(self, "date_to", compact_date(self.date_to))
        object.__setattr__(self, "page_limit", int(self.page_limit))
        object.__setattr__(self, "keywords", tuple(self.keywords))
        if not 1 <= self.page_limit <= MAX_PAGE_RECORDS:
            raise ValueError(f"page_limit must be 1 to {MAX_PAGE_RECORDS}")
        if self.file_records < 1:
            raise ValueError("file_records must be at least 1")
        if not self.manufacturer.strip():
            raise ValueError("an empty manufacturer would match every device")
        if not re.fullmatch(r"[\w.-]+", self.run_id, re.ASCII):
            raise ValueError("run_id names a folder: letters, digits, '_', '.' and '-' only")

    @classmethod
    def from_mapping(cls, config: Mapping, **overrides) -> JobParams:
        """Parameters from a parsed config; non-null overrides (widgets, CLI) win."""
        merged = dict(config)
        merged.update({k: v for k, v in overrides.items() if v is not None})
        unknown = set(merged) - {f.name for f in dataclasses.fields(cls)}
        if unknown:
            raise ValueError(f"unknown parameters: {sorted(unknown)}")
        return cls(**merged)
