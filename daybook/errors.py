"""One error type for failed data contracts; Spark's own errors pass through."""

from __future__ import annotations


class DataContractError(Exception):
    """A measured contract did not hold. Carries the contract name and values."""

    def __init__(self, contract: str, message: str, values: dict | None = None):
        self.contract = contract
        self.values = dict(values or {})
        super().__init__(f"[{contract}] {message} {self.values}")
