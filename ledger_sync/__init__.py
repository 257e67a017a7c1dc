"""Wallet-ledger sync on Spark: clean extracts, upsert them, refresh balances."""

from ledger_sync.schemas import DAG, PRESETS, SCRIPT, SCRIPT_CAPPED, Limits, Preset

__all__ = ["DAG", "PRESETS", "SCRIPT", "SCRIPT_CAPPED", "Limits", "Preset"]
