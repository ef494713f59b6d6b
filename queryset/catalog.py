"""The catalogue of registered queries and the SQL fragments they share."""

from datetime import datetime

RUN_TS = datetime(2026, 3, 1, 12, 0, 0)
RUN_TEXT = "2026-03-01T12:00:00"

QUERIES = {}
ORACLES = {}

# White space as Python sees it, for RE2.
_S = r"\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def query(sql=None):
    """Register a function (spark, sf_dir) under its name, with its SQL if there is one."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def strip_sql(x):
    return f"regexp_replace({x}, '^[{_S}]+|[{_S}]+$', '', 'g')"


def squeeze_sql(x):
    return f"regexp_replace({x}, '[{_S}]+', ' ', 'g')"


def text_sql(x):
    return f"coalesce(CAST({x} AS VARCHAR), '')"


def fold_sql(x):
    """The key fold for text without compatibility characters."""
    return f"upper(strip_accents(replace(trim({squeeze_sql(text_sql(x))}), 'ß', 'ss')))"


def ascii_sql(x):
    """The ASCII fold for text without compatibility characters."""
    return f"upper(regexp_replace(strip_accents({strip_sql(text_sql(x))}), '[^\\x00-\\x7F]', '', 'g'))"


def blank_sql(x):
    return f"({x} IS NULL OR {strip_sql(x)} = '')"
