"""Part of strandlake."""
