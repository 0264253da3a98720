"""Registered queries, each with the SQL that checks it."""

_QUERIES = {}
_ORACLES = {}


def query(name, sql=None):
    """Registers a ``(spark, folder) -> DataFrame`` function and its oracle."""

    def register(function):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = function
        if sql is not None:
            _ORACLES[name] = sql
        return function

    return register


def load():
    from contract import (  # noqa: F401
        analytics,
        bronze,
        enrichment,
        gold,
        quality,
        scalars,
        silver,
        streams,
        tables,
        upkeep,
    )

    return dict(_QUERIES), dict(_ORACLES)
