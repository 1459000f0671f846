"""Lake settings: folders, databases and storage format, passed as one object."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass, field


def join_path(prefix: str, *parts: str) -> str:
    out = prefix.rstrip("/")
    for p in parts:
        out = posixpath.join(out, str(p).strip("/"))
    return out


@dataclass(frozen=True)
class LakeConfig:
    """Where each layer lives.

    ``incoming`` is also the landing folder: files are loaded from where they
    arrive, and loading a file again adds no rows.
    """

    incoming: str
    archive: str
    conformed: str
    enriched: str
    sandbox: str
    backup: str
    conformed_db: str = "conformed"
    enriched_db: str = "enriched"
    sandbox_db: str = "sandbox"
    metadata_db: str = "lakemeta"
    business_table: str = "business_metadata"
    technical_table: str = "technical_metadata"
    fmt: str = "parquet"
    # Backup of the conformed layer before each append. "files": copy only files
    # that no kept backup holds (sources.backup); "table": copy the whole
    # table; "partitions": copy only the partitions that the append writes to.
    backup_scope: str = "files"
    backups_kept: int = 1
    # Count whole stored layers before and after each load (F1 "existing" and
    # "after"). Off by default: it lists and reads every file footer of the
    # layer; the new-row count is always exact without it.
    full_counts: bool = False
    # Keys with more rows than this in one batch are settled outside the
    # anti-join's shuffle (see operators.increment.hot_keys). None: off.
    hot_key_rows: int | None = 1_000_000
    # Keep a bucketed index of the row hashes of the typed layers and the
    # warehouse tables (sources.keyindex), with so many buckets (None: as many
    # as shuffle partitions when it is built).
    key_index: bool = True
    key_buckets: int | None = None
    # Keep the values that casts lose in a table next to each layer
    # (sources.quarantine); they are counted in the load results anyway.
    quarantine: bool = True
    # Keep membership bitmaps of the conformed layer with domains of so many
    # bits (operators.membership.domain_bits); None: none.
    membership_bits: int | None = None
    # Files of one dataset that are loaded at once, exactly as one after another
    # (see operators.fold; at most MAX_FOLD_FILES). 1: one at a time.
    fold_files: int = 62
    extra: dict = field(default_factory=dict)

    @classmethod
    def under(cls, root: str, **kw) -> "LakeConfig":
        """All folders below one root (tests, single-bucket deployments)."""
        return cls(
            incoming=join_path(root, "incoming"),
            archive=join_path(root, "archive"),
            conformed=join_path(root, "conformed"),
            enriched=join_path(root, "enriched"),
            sandbox=join_path(root, "sandbox"),
            backup=join_path(root, "backup"),
            **kw,
        )

    def layer_path(self, layer: str, subpath: str) -> str:
        base = {
            "conformed": self.conformed,
            "enriched": self.enriched,
            "sandbox": self.sandbox,
            "backup": self.backup,
        }[layer]
        return join_path(base, subpath)

    def layer_db(self, layer: str) -> str:
        return {
            "conformed": self.conformed_db,
            "enriched": self.enriched_db,
            "sandbox": self.sandbox_db,
        }[layer]
