"""telemetra: sensor-observation analytics on Spark DataFrames.

Batch and Structured Streaming share the same column expressions; see
``telemetra.plans.pipeline`` for the end-to-end flow.
"""

__version__ = "0.1.0"
