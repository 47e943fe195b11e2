"""The SQL twin of every job that SQL can express, by job name."""

from __future__ import annotations

from tidemill.plans import oracle_models, oracle_pipeline, oracle_relational

SQL: dict[str, str] = {**oracle_relational.SQL, **oracle_pipeline.SQL, **oracle_models.SQL}
