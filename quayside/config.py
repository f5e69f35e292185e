"""Settings of an intake."""

from __future__ import annotations

from dataclasses import dataclass

from quayside import vocabulary as v


@dataclass(frozen=True)
class IntakeConfig:
    """Where files land, where tables and logs live, and the few policy switches.

    landing_root         Hadoop path; each category is a folder below it
    store_root           Hadoop path for dated tables, logs and registries
    driven_by            "folder" walks the waiting files and archives them,
                         "manifest" walks the manifest rows and leaves the files
    strict_rows_loaded   a load whose row count differs is not published
    history_by_category  the "was it ever loaded" test looks at one category only
    text_columns         upper-case column names never inferred as numbers or dates
    max_parallel_loads   load jobs submitted at the same time
    """

    landing_root: str
    store_root: str
    ops_db: str = "ops"
    driven_by: str = "folder"
    database: str = v.DATABASE
    manifest_prefix: str = v.MANIFEST_PREFIX
    strict_rows_loaded: bool = True
    history_by_category: bool = False
    text_columns: frozenset[str] = frozenset()
    max_parallel_loads: int = 4

    def __post_init__(self) -> None:
        if self.driven_by not in ("folder", "manifest"):
            raise ValueError(f"driven_by must be 'folder' or 'manifest', not {self.driven_by!r}")
        object.__setattr__(self, "landing_root", self.landing_root.rstrip("/"))
        object.__setattr__(self, "store_root", self.store_root.rstrip("/"))

    def folder(self, category: str) -> str:
        return f"{category}/"

    def history(self, category: str) -> str:
        return f"{category}/{v.HISTORY_FOLDER}/"

    def manifest_name(self, category: str) -> str:
        return f"{self.manifest_prefix}_{category}.csv"

    def table_label(self, category: str, table_nm: str) -> str:
        return f"{self.database}.{category}.{table_nm}"
