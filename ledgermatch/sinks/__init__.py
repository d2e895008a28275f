"""Writers for reconciliation outputs."""
