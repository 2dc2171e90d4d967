"""What the entry module adds of this subpackage."""

from __future__ import annotations

import corpus_pipeline

from tripflow.llm.oracles import ORACLES as _ORACLES
from tripflow.llm.queries import QUERIES as _QUERIES

QUERIES = _QUERIES | {"pipeline": corpus_pipeline.run}
ORACLES = _ORACLES | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
