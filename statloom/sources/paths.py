"""Addresses of the raw, processed and warehouse zones."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from hashlib import md5


@dataclass(frozen=True)
class Zones:
    """A storage root and a dataset name; the run date is the only run parameter.

    The catalog database of the dataset's tables and views is named after both, unless it is given.
    """

    root: str
    dataset: str
    catalog: str | None = None

    @property
    def database(self) -> str:
        return self.catalog or f"{self.dataset}_{md5(self.root.encode()).hexdigest()[:8]}"

    def table(self, name: str) -> str:
        return f"`{self.database}`.{name}"

    def raw(self, run_date: date | str, feed: str) -> str:
        return f"{self.root}/raw/{self.dataset}/{_iso(run_date)}/{feed}.json"

    def raw_runs(self, feed: str) -> str:
        """Every run date of a feed."""
        return f"{self.root}/raw/{self.dataset}/*/{feed}.json"

    def processed(self, run_date: date | str, feed: str) -> str:
        return f"{self.root}/processed/{self.dataset}/{_iso(run_date)}/{feed}"

    def rejects(self, run_date: date | str, feed: str) -> str:
        return f"{self.root}/rejected/{self.dataset}/{_iso(run_date)}/{feed}.json"

    def audits(self, run_date: date | str, feed: str) -> str:
        """What became of a run's records, beside its rejects."""
        return f"{self.root}/rejected/{self.dataset}/{_iso(run_date)}/{feed}.audit.json"

    def run_folders(self) -> list[str]:
        """The folders that hold one folder per run date."""
        return [f"{self.root}/{zone}/{self.dataset}" for zone in ("raw", "processed", "rejected")]

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{self.dataset}/{table}"


def _iso(run_date: date | str) -> str:
    return (date.fromisoformat(run_date) if isinstance(run_date, str) else run_date).isoformat()
