"""Part of strandworks: sources."""
