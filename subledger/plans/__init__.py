"""The ten models, KPI queries, materialised pipeline and query registry."""
