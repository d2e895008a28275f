"""Two-ledger transaction reconciliation on Spark DataFrames.

The main entry points, importable from the package root:

* ``reconcile`` / ``MatchSpec``: the configurable matcher (three outputs);
* ``stage_internal`` / ``stage_external`` / ``fct_reconciled``: the fact table;
* ``status_summary`` and the ``quality`` tests;
* ``JobSpec`` / ``run_job`` / ``batch_pipeline`` / ``run_stream_job``;
* ``reconcile_stream``: windowed stream-stream reconciliation.
"""

__version__ = "0.1.0"

from ledgermatch.functions import StatusLabels
from ledgermatch.operators import quality
from ledgermatch.operators.mart import fct_reconciled
from ledgermatch.operators.reconcile import MatchSpec, ReconResult, reconcile
from ledgermatch.operators.staging import stage_external, stage_internal
from ledgermatch.operators.summary import match_rate, status_counts, status_summary
from ledgermatch.plans.jobs import batch_pipeline, run_job, run_stream_job
from ledgermatch.spec import JobSpec, OutputSpec, SourceSpec, WindowSpec
from ledgermatch.streaming.reconcile import reconcile_stream, window_metrics

__all__ = [
    "JobSpec", "MatchSpec", "OutputSpec", "ReconResult", "SourceSpec", "StatusLabels", "WindowSpec",
    "batch_pipeline", "fct_reconciled", "match_rate", "quality", "reconcile", "reconcile_stream", "run_job",
    "run_stream_job", "stage_external", "stage_internal", "status_counts", "status_summary", "window_metrics",
]
