"""Contributor-activity and audit-log analytics as Spark DataFrame transformations."""
