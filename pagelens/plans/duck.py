"""DuckDB SQL snippets for the oracle texts (RE2 regex, byte-length strlen).

These are written independently of the Spark expressions: RE2 has no
back-references, so script/style removal is two passes here; DuckDB's
``regexp_replace`` needs the ``'g'`` flag to replace all matches.
"""

WS = "chr(32) || chr(9) || chr(10) || chr(13) || chr(11)"


def strip_sql(x: str) -> str:
    s = f"regexp_replace({x}, '(?is)<script[^>]*?>.*?</script>', '', 'g')"
    s = f"regexp_replace({s}, '(?is)<style[^>]*?>.*?</style>', '', 'g')"
    s = f"regexp_replace({s}, '<(?:[^\\s>][^>]*)?>', '', 'g')"
    return f"trim({s}, {WS})"


def tags_only_sql(x: str) -> str:
    return f"regexp_replace({x}, '<(?:[^\\s>][^>]*)?>', '', 'g')"


def wc_sql(x: str) -> str:
    t = f"regexp_replace(regexp_replace({x}, '^[''-]', ''), '-\\z', '')"
    return f"CAST(len(regexp_extract_all({t}, '[A-Za-z''-]+')) AS BIGINT)"


def host_sql(x: str) -> str:
    return f"regexp_extract({x}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1)"


def path_sql(x: str) -> str:
    p = f"regexp_extract({x}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    return f"CASE WHEN {p} = '' THEN '/' ELSE {p} END"


def falsy_sql(x: str) -> str:
    return f"({x} IS NULL OR {x} = '' OR {x} = '0')"


def elvis_sql(x: str, y: str) -> str:
    return f"CASE WHEN {falsy_sql(x)} THEN {y} ELSE {x} END"


def blen(x: str) -> str:
    return f"CAST(strlen({x}) AS BIGINT)"
