"""Part of strandworks: plans."""
