"""ledgerlight: customer-analytics operators expressed as Spark DataFrame jobs.

Subpackages
-----------
sources     reading the driver tables, reference-shaped adapters, files and catalog
operators   the analytics: order rollups, recurring revenue, attribution,
            presentation tables, text cleaning, vector search, models
functions   column-level helpers (dates, hashing, text)
plans       plan-shaping helpers: checked broadcast, skew-safe ordering,
            lineage cuts
streaming   idempotent micro-batch import built on the batch operators
"""

__all__ = ["sources", "operators", "functions", "plans", "streaming"]
