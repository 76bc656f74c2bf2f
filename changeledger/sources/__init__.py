"""Readers of landed files. Schemas are explicit, so no reader runs an inference job."""
