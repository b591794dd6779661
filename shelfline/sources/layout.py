"""Dataset addressing (R8): ``{root}/{step}/{layer}/{table}[/version=V]``."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Lake:
    root: str
    fmt: str = "parquet"  # format of the managed tables (curated and serving)
    #: ((step, layer), root) of layers that are kept below another root.
    elsewhere: tuple[tuple[tuple[str, str], str], ...] = ()

    def path(self, step: str, layer: str, table: str, version: str | None = None) -> str:
        root = dict(self.elsewhere).get((step, layer), self.root)
        p = f"{root.rstrip('/')}/{step}/{layer}/{table}"
        return p if version is None else f"{p}/version={version}"

    def table(self, where: tuple[str, str], table: str, version: str | None = None) -> str:
        return self.path(where[0], where[1], table, version)
