"""Where the zones' tables lie under a base path."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Zones:
    base: str

    @property
    def raw_transactions(self) -> str:
        return f"{self.base}/raw/transactions"

    @property
    def raw_rates(self) -> str:
        return f"{self.base}/raw/cdi"

    @property
    def rescued_rates(self) -> str:
        """Answers of the rate service that could not be used, with the reason."""
        return f"{self.base}/raw/cdi_rescued"

    @property
    def transactions(self) -> str:
        return f"{self.base}/curated/transactions"

    @property
    def rates(self) -> str:
        return f"{self.base}/curated/cdi"

    @property
    def payouts(self) -> str:
        return f"{self.base}/analytics/payouts"

    @property
    def totals(self) -> str:
        """Sums per account by day; they stand for all earlier movements."""
        return f"{self.base}/analytics/totals"

    def touched(self, of: str) -> str:
        """Accounts with movements that came after the table ``of`` had passed their day."""
        return f"{self.base}/analytics/touched_{of}"

    @property
    def manifest(self) -> str:
        """What is known of each raw file."""
        return f"{self.base}/curated/manifest"

    @property
    def ledger_state(self) -> str:
        """Where the ledger of each account stands."""
        return f"{self.base}/analytics/ledger_state"

    @property
    def ledger(self) -> str:
        return f"{self.base}/analytics/ledger"

    @property
    def rejected(self) -> str:
        """Raw rows that break a rule, with the reasons."""
        return f"{self.base}/curated/rejected"
