"""The corpus pipeline of the training-data operators; see strandlake/llm/pipeline.py."""

from strandlake.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
