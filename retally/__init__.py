"""retally — scrutiny (re-totalling / re-valuation) reporting on Spark.

Published exam results, paid applications and payment drops are reconciled per
exam group, wide application rows are fanned out to one row per applied paper
in a single distributed pass, forms already reported are excluded, and gated
reports are written.  Everything is DataFrame / SQL work planned by Catalyst.

Layout
------
``functions``  column expressions (dates, JSON notes, tokens, casts)
``operators``  reusable relational building blocks (fan-out, membership
               joins with SQL ``IN`` / ``NOT IN`` semantics, gate, set diff)
``sources``    exam tables (catalog, parquet, derived), file listings, sinks
``plans``      the user-facing jobs (status, reconciliation, reports, runs)
``streaming``  incremental ingest of payment drops
"""

from retally.specs import REPORTS, ReportSpec  # noqa: F401

__all__ = ["REPORTS", "ReportSpec"]
