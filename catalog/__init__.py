"""Named queries over the given tables, each beside the SQL it is compared with."""

from importlib import import_module

MODULES = ("layers", "panels", "profiling", "exploring", "quality", "changes")


def _load():
    for name in MODULES:
        import_module(f"catalog.{name}")
    from catalog import base

    return base


def all_queries():
    return dict(_load().QUERIES)


def all_sql():
    return dict(_load().SQL)
