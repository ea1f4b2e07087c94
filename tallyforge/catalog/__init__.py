"""Every operator as a query over the test tables, with the SQL that checks it."""

from importlib import import_module

_PARTS = ("sources", "logs", "profiles", "recommender", "learning", "texts", "graphs", "streams")


def load_all() -> None:
    for part in _PARTS:
        import_module(f"tallyforge.catalog.{part}")
