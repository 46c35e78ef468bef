"""All queries and SQL of this subpackage, the pipeline included."""

from __future__ import annotations

import corpus_pipeline

from .queries import ORACLE_SQL, QUERIES

ALL_QUERIES = QUERIES | {"pipeline": corpus_pipeline.run}
ALL_SQL = dict(ORACLE_SQL)
