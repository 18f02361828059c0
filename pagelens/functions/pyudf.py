"""Arrow-batched pandas UDFs: the few places with no SQL expression form.

(No ``from __future__ import annotations`` here: pandas_udf reads the type
hints at definition time.)
"""

import json

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

# Keys whose values are never logged (matched case-insensitively).
SENSITIVE_KEYS = ("api_key", "password", "secret", "token", "authorization")
REDACTED = "[REDACTED]"


def _redact_walk(v):
    if isinstance(v, dict):
        return {k: (REDACTED if str(k).lower() in SENSITIVE_KEYS else _redact_walk(x)) for k, x in v.items()}
    if isinstance(v, list):
        return [_redact_walk(x) for x in v]
    return v


def _redact_one(x):
    if x is None:
        return None
    try:
        return json.dumps(_redact_walk(json.loads(x)), separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return x


@pandas_udf(StringType())
def redact_nested_json(s: pd.Series) -> pd.Series:
    """Parse each JSON text and replace sensitive keys' values at any depth."""
    return s.map(_redact_one)


def _scripts(m, ascii_only):
    if m is None:
        return None
    out = []
    for _, value in (m.items() if isinstance(m, dict) else m):
        try:
            value = json.dumps(json.loads(value), indent=4, ensure_ascii=ascii_only)
        except ValueError:
            pass
        out.append(f'<script type="application/ld+json">\n{value}\n</script>\n')
    return "".join(out)


@pandas_udf(StringType())
def schema_scripts(maps: pd.Series) -> pd.Series:
    """The JSON-LD script elements of a map (type -> JSON text), each schema printed over several lines.

    Four blanks a level, slashes as they are, other than ASCII escaped; text that is no JSON stays as it is.
    """
    return maps.map(lambda m: _scripts(m, True))


@pandas_udf(StringType())
def schema_scripts_unicode(maps: pd.Series) -> pd.Series:
    """``schema_scripts`` with characters beyond ASCII as they are."""
    return maps.map(lambda m: _scripts(m, False))


@pandas_udf(StringType())
def rewrite_h1(tree: pd.Series, title: pd.Series, path: pd.Series, seed: pd.Series) -> pd.Series:
    """A builder tree's JSON with the heading at ``path`` made the H1 of this title, or, without a path, with a new
    section on top that holds it (its three ids are read off ``seed``)."""
    def one(tree, title, path, seed):
        try:
            nodes = json.loads(tree) if tree else []
        except ValueError:
            nodes = []
        nodes = nodes if isinstance(nodes, list) else []
        if path is None or not len(path):
            widget = {"id": seed[14:21], "elType": "widget", "widgetType": "heading",
                      "settings": {"title": title, "header_size": "h1", "align": "left"}, "elements": []}
            column = {"id": seed[7:14], "elType": "column", "settings": {"_column_size": 100}, "elements": [widget]}
            nodes = [{"id": seed[:7], "elType": "section", "settings": {}, "elements": [column]}, *nodes]
        else:
            node = {"elements": nodes}
            for i in path:
                node = node["elements"][int(i)]
            settings = node.get("settings")
            node["settings"] = {**(settings if isinstance(settings, dict) else {}), "title": title, "header_size": "h1"}
        return json.dumps(nodes, separators=(",", ":"), ensure_ascii=False)
    return pd.Series([one(*row) for row in zip(tree, title, path, seed)], dtype=object)
