"""Registered queries of this subpackage and the SQL that checks them."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Registers a ``(spark, folder) -> DataFrame`` function and its oracle."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
