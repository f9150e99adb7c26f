"""subledger: subscription and payment analytics as Spark DataFrame jobs.

Layers (all lazily composed DataFrames, materialised only by ``plans.pipeline``):

* ``sources``   - bronze inputs (all-text tables), CSV bulk load, versioned sinks
* ``functions`` - scalar column helpers (safe casts, date parsing, flags)
* ``operators`` - reusable relational steps (dedup, rule classification,
                  keyed upsert, data-quality checks, revenue movements)
* ``plans``     - the ten models (silver, quarantine, gold), KPI queries,
                  the pipeline build and the query registry
* ``streaming`` - file-triggered incremental quarantine (Structured Streaming)
"""

from subledger.params import RunParams

__all__ = ["RunParams"]
