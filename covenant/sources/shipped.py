"""Contracts shipped with the package for the test tables (JSON files next to this module)."""

from __future__ import annotations

import json
from pathlib import Path

FOLDER = Path(__file__).with_name("contract_files")


def load(name: str) -> dict:
    return json.loads((FOLDER / f"{name}_contract.json").read_text())


def names() -> list[str]:
    return sorted(p.name[: -len("_contract.json")] for p in FOLDER.glob("*_contract.json"))
