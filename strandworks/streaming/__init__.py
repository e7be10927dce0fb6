"""Part of strandworks: streaming."""
