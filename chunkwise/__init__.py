"""chunkwise: labelled long-text processing as Spark DataFrame jobs.

Sub-packages:
  functions  - Column -> Column text, array and vector expressions
  operators  - DataFrame -> DataFrame operators (filters, splits, stats, metrics, features, models)
  sources    - readers and writers
  plans      - bindings to the driver tables and the registered queries
  streaming  - Structured Streaming scoring
"""

from chunkwise.session import get_session, checkpoint_dir  # noqa: F401
