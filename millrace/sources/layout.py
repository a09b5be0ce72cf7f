"""Where each stage keeps its tables and its progress below one shared root folder."""

from __future__ import annotations

from dataclasses import dataclass


def clean_name(table: str) -> str:
    """``public.orders`` -> ``orders``."""
    return table.rsplit(".", 1)[-1]


@dataclass(frozen=True)
class Layout:
    root: str

    def landing(self, table: str) -> str:
        return f"{self.root}/landing/{table.replace('.', '_')}"

    def table(self, table: str) -> str:
        return f"{self.root}/tables/{clean_name(table)}"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{clean_name(table)}"

    def mart(self, mart: str, mode: str, build: int) -> str:
        return f"{self.root}/marts_{mode}/{mart}/build={build}"

    def state(self, stage: str, table: str) -> str:
        name = table.replace(".", "_") if stage == "extract" else clean_name(table)
        return f"{self.root}/state/{stage}/{name}"

    def paths_of(self, table: str) -> list[str]:
        """Every folder that belongs to one source table."""
        stages = ("extract", "transform", "intent", "load", "stream_transform", "stream_load")
        return [self.landing(table), self.table(table), self.warehouse(table), *[self.state(s, table) for s in stages]]
