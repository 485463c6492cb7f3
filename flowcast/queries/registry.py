"""Decorator that registers a query with its SQL equivalent."""


def registrar():
    queries, oracles = {}, {}

    def query(sql=None):
        def register(run):
            queries[run.__name__] = run
            if sql is not None:
                oracles[run.__name__] = sql
            return run
        return register

    return queries, oracles, query
