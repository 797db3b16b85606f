"""The query catalog."""

from importlib import import_module

from prospectra.catalog.registry import ENTRIES, Entry

SECTIONS = ("columns", "sources", "tables", "scoring", "evidence", "outreach", "health", "streams")


def load() -> dict[str, Entry]:
    """All registered queries by name."""
    for section in SECTIONS:
        import_module(f"prospectra.catalog.{section}")
    return ENTRIES
