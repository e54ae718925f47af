"""Schemas, typed loading, the driver test-data mapping and the stored model."""
