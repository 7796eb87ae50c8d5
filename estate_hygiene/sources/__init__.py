"""Readers and writers for the estate tables, the control table and the workflow state."""
