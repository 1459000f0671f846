"""strata: metadata-driven, incremental loading of tabular files into a
layered lake (conformed, enriched, sandbox) and a warehouse, on Spark."""

from .config import LakeConfig
from .plans import (
    LoadResult,
    Target,
    conformed_batch,
    load_business_metadata,
    load_conformed,
    load_enriched,
    load_sandbox,
    load_technical_metadata,
    load_warehouse,
    route_files,
    run_pipeline,
)

__all__ = [
    "LakeConfig",
    "LoadResult",
    "Target",
    "conformed_batch",
    "load_business_metadata",
    "load_conformed",
    "load_enriched",
    "load_sandbox",
    "load_technical_metadata",
    "load_warehouse",
    "route_files",
    "run_pipeline",
]
