"""The registered queries, each next to the SQL that must give the same rows."""

from importlib import import_module

_MODULES = ("registry", "classification", "parcels", "activity")


def _load():
    for name in _MODULES:
        import_module(f"queryset.{name}")


def all_queries():
    _load()
    from queryset.catalog import QUERIES

    return dict(QUERIES)


def all_oracles():
    _load()
    from queryset.catalog import ORACLES

    return dict(ORACLES)
