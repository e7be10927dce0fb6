"""Part of strandworks: functions."""
