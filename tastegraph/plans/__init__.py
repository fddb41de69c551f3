"""The query catalogue."""

from importlib import import_module

MODULES = ("base_sql", "ratings", "text_sql", "text", "profiles", "inputs", "adlogs", "graphs", "models",
           "streams")


def load():
    """Import every query module and return the filled registry."""
    for name in MODULES:
        import_module(f"{__name__}.{name}")
    return import_module(f"{__name__}.registry")
