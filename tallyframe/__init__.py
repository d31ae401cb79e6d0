"""Snapshot quality checks, versioned publication and portfolio metrics on Spark."""

from tallyframe.contract import CARD, Band, Contract, Rule, Slot
from tallyframe.operators.checks import (
    grain_violations,
    monthly_from_wide,
    orphan_count,
    orphans,
    reconcile,
    reconcile_rows,
)
from tallyframe.operators.gate import batch_counts, gate_outcomes
from tallyframe.operators.metrics import alerts, monthly, segments
from tallyframe.operators.quality import prepare, snapshot_digest
from tallyframe.operators.reshape import build_silver
from tallyframe.plans.publish import integrity_report, publish, publish_file
from tallyframe.sources.pins import file_hashes, manifest, source_pin
from tallyframe.sources.snapshot import read_snapshot, require_digest

__all__ = [
    "CARD", "Band", "Contract", "Rule", "Slot",
    "alerts", "batch_counts", "build_silver", "file_hashes", "gate_outcomes", "grain_violations",
    "integrity_report", "manifest", "monthly", "monthly_from_wide", "orphan_count", "orphans",
    "prepare", "publish", "publish_file", "read_snapshot", "reconcile", "reconcile_rows", "require_digest",
    "segments", "snapshot_digest", "source_pin",
]
