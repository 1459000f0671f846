"""Composite loads (the user-facing API): metadata, raw, conformed,
enriched, sandbox, warehouse and the whole run."""

from .conformed import batch_days, conformed_batch, load_conformed
from .metadata import load_business_metadata, load_technical_metadata, spec_for
from .pipeline import land_raw, load_dataset_files, route_files, run_pipeline
from .target import LoadResult, Target
from .typed import load_enriched, load_sandbox, load_typed_layer, typed_batch
from .warehouse import load_warehouse
