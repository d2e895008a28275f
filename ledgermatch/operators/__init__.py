"""DataFrame-in, DataFrame-out reconciliation operators."""
