"""logweave: log feature analytics expressed as Spark DataFrame plans.

Event logs ``(FileID, CustomerID, QueryTs, ProductID)`` are turned into
per-file behavioural features (counts, distinct counts, calendar
histograms, inter-event intervals, TF-IDF summaries, per-second tensors),
train/test overlap sets, prepared tabular data and Spark ML models.

Sub-packages:

* ``sources``   readers, writers and the test-table fixtures
* ``functions`` column-level helpers (stat registry, sets, calendar, encoding)
* ``operators`` DataFrame -> DataFrame operators
* ``plans``     named end-to-end queries used by the driver and bench
* ``streaming`` Structured Streaming twins of the incremental paths
"""

from logweave.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
