"""Part of strandline."""
