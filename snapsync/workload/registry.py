"""Registry of queries and of the SQL that checks them."""

import re

QUERIES = {}
SQL = {}
FIXTURE_SQL = {}


def query(name, sql=None):
    """Register a function (spark, sf_dir) -> DataFrame; fx_ names in the SQL become CTEs."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def _needed(sql, found):
    for name in re.findall(r"\bfx_\w+", sql):
        if name not in found:
            _needed(FIXTURE_SQL[name], found)
            found[name] = FIXTURE_SQL[name]
    return found


def checked_sql(name):
    ctes = _needed(SQL[name], {})
    if not ctes:
        return SQL[name]
    parts = ",\n".join(f"{k} as ({v})" for k, v in ctes.items())
    body = SQL[name].strip()
    if body.lower().startswith("with "):
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"
