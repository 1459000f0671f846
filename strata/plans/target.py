"""One routed file and the names derived for it (C13), plus load results."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from ..functions import targets


@dataclass(frozen=True)
class Target:
    path: str
    name: str
    dataset: str
    root: str
    database: str
    schema: str
    table: str
    sql_database: str
    sql_schema: str
    sql_table: str
    sql_view: str
    flags: dict = field(default_factory=dict)

    @classmethod
    def from_row(cls, row) -> "Target":
        r = row.asDict() if hasattr(row, "asDict") else dict(row)
        return cls(
            path=r["path"],
            name=r["name"],
            dataset=r["dataset"],
            root=r["deltaLake_root"],
            database=r["delta_database_name"],
            schema=r["delta_schema_name"],
            table=r["deltaLake_table_name"],
            sql_database=r["sql_database_name"],
            sql_schema=r["sql_schema_name"],
            sql_table=r["sql_table_name"],
            sql_view=r["sql_view_name"],
            flags={k: r.get(k) for k in ("raw_layer", "conformed_layer", "enrich_layer", "sandbox_layer", "edw_layer")},
        )

    @property
    def subpath(self) -> str:
        return targets.layer_subpath(self.root, self.database, self.schema, self.table)

    @property
    def catalog_table(self) -> str:
        return targets.catalog_table(self.sql_schema, self.sql_table)

    @property
    def warehouse_db(self) -> str:
        """One catalog database per warehouse database and schema."""
        for name in (self.sql_database, self.sql_schema):
            if "__" in name or name.startswith("_") or name.endswith("_"):
                raise ValueError(f"warehouse name {name!r}: an outer or double underscore would be ambiguous")
        return targets.warehouse_db(self.sql_database, self.sql_schema)

    @property
    def staging_schema(self) -> str:
        self.warehouse_db  # refuses ambiguous names
        return targets.staging_db(self.sql_database, self.sql_schema)

    def same_targets(self, other: "Target") -> bool:
        """Whether both files go to the same layers and tables."""
        return replace(self, path=other.path, name=other.name) == other

    def runs(self, flag: str) -> bool:
        """Business flags must be exactly ``Y``."""
        return self.flags.get(flag) == "Y"


@dataclass
class LoadResult:
    layer: str
    target: str
    # None: not counted in this load.
    existing: int | None = None
    incoming: int | None = None
    new: int | None = None
    after: int | None = None
    # Incoming rows that had to be looked up among the stored keys.
    looked_up: int | None = None
    # Values that casts lost, by column, in the rows that were read.
    failed: dict = field(default_factory=dict)
    created: bool = False
    partitions: list | None = None
    backup: str | None = None
    notes: list = field(default_factory=list)

    def as_dict(self) -> dict:
        return dict(self.__dict__)
