"""Weight tables that jobs read; a caller may pass rows of its own instead."""

from __future__ import annotations

import csv
import os


def rows(name: str) -> list[dict[str, str]]:
    """The rows of ``<name>.csv`` of this folder."""
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.csv"), newline="") as f:
        return list(csv.DictReader(f))
