"""Query registry: every module here registers named queries on import."""

from importlib import import_module
from pkgutil import iter_modules


def load_all() -> None:
    for mod in iter_modules(__path__):
        import_module(f"{__name__}.{mod.name}")
