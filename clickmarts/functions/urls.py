"""URL helpers (F3-F8): query parameters, URL parts, paths, escapes."""

from __future__ import annotations

from typing import Callable, Optional

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The URL grammar of the reference model.  One pattern per part;
# they differ only in which group captures.  Must stay byte-identical.
# ---------------------------------------------------------------------------
URL_PART_PATTERNS = {
    "protocol": r"^(?:([^@:\/\s]+):\/?)?\/?(?:[^@:\/\s\?]+)(?::(?:\d+))?(?:[^\?#]*)?\??(?:[^#]*)?#?(?:.+)?",
    "hostname": r"^(?:(?:[^@:\/\s]+):\/?)?\/?([^@:\/\s\?]+)(?::(?:\d+))?(?:[^\?#]*)?\??(?:[^#]*)?#?(?:.+)?",
    "port": r"^(?:(?:[^@:\/\s]+):\/?)?\/?(?:[^@:\/\s\?]+)(?::(\d+))?(?:[^\?#]*)?\??(?:[^#]*)?#?(?:.+)?",
    "path": r"^(?:(?:[^@:\/\s]+):\/?)?\/?(?:[^@:\/\s\?]+)(?::(?:\d+))?([^\?#]*)?\??(?:[^#]*)?#?(?:.+)?",
    "query": r"^(?:(?:[^@:\/\s]+):\/?)?\/?(?:[^@:\/\s\?]+)(?::(?:\d+))?(?:[^\?#]*)?\??([^#]*)?#?(?:.+)?",
    "fragment": r"^(?:(?:[^@:\/\s]+):\/?)?\/?(?:[^@:\/\s\?]+)(?::(?:\d+))?(?:[^\?#]*)?\??(?:[^#]*)?#?(.+)?",
}
# Parts whose group can only capture a non-empty string: an empty extract
# means "did not participate" and becomes NULL.  path and query may
# legitimately be empty and keep ''.
_NON_EMPTY_PARTS = frozenset({"protocol", "hostname", "port", "fragment"})

# The 26 escapes decoded by the reference, in application order.
COMMON_ESCAPES = (
    ("%7C", "|"), ("%20", " "), ("%21", "!"), ("%2E", "."), ("%2C", ","),
    ("%2F", "/"), ("%3A", ":"), ("%3B", ";"), ("%3F", "?"), ("%40", "@"),
    ("%23", "#"), ("%24", "$"), ("%25", "%"), ("%26", "&"), ("%27", "'"),
    ("%28", "("), ("%29", ")"), ("%2A", "*"), ("%2B", "+"), ("%3D", "="),
    ("%5B", "["), ("%5D", "]"), ("%7B", "{"), ("%7D", "}"), ("%3C", "<"),
    ("%3E", ">"),
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_param(url, name: str) -> Column:
    """First value of ``name=`` in the URL, NULL when absent.

    The match is unanchored (``campaign_id=`` also matches inside
    ``utm_campaign_id=``) and the value is not URL-decoded, as in the
    reference.  One regex evaluation (the whole ``name=value`` match, minus
    the prefix; NULL when nothing matches), and it only runs when the literal
    ``name=`` occurs - exact, since the pattern requires it - which skips
    most of the regex work over the many parameters read per URL.
    """
    u = _c(url)
    needle = f"{name}="
    match = F.regexp_substr(u, F.lit(f"{name}=[^&#]+"))
    # No length argument: the match stands in the expression once.
    return F.when(u.contains(needle), F.substr(match, F.lit(len(needle) + 1)))


# All parts captured by one pattern: every group of the patterns above, and the rest of the text.
_ALL_PARTS = (r"^(?:([^@:\/\s]+):\/?)?\/?([^@:\/\s\?]+)(?::(\d+))?([^\?#]*)?\??([^#]*)?#?(.+)?[\s\S]*")
_PART_ORDER = ("protocol", "hostname", "port", "path", "query", "fragment")
# Between the parts; two control characters that no URL has in a row.
_BETWEEN = "\x01\x02"


def url_parts(url) -> dict[str, Column]:
    """All parts of a URL, equal to :func:`url_part` of each, from one match of one pattern.

    The match is replaced by its six groups with a mark before each; a URL that does not
    parse stays whole, so that its split has no further elements and all parts are NULL.
    The array is one common expression of all parts.
    """
    groups = F.split(F.regexp_replace(_c(url), F.lit(_ALL_PARTS), F.lit("".join(f"{_BETWEEN}${i}" for i in range(1, 7)))),
                     _BETWEEN)
    out = {}
    for i, part in enumerate(_PART_ORDER, 1):
        value = F.get(groups, F.lit(i))
        out[part] = F.nullif(value, F.lit("")) if part in _NON_EMPTY_PARTS else value
    return out


def url_part(url, part: str) -> Column:
    """One part of a URL by the reference grammar; NULL when the URL does not parse."""
    pattern = URL_PART_PATTERNS[part]
    u = _c(url)
    value = F.regexp_extract(u, pattern, 1)
    if part in _NON_EMPTY_PARTS:
        value = F.nullif(value, F.lit(""))
    return F.when(u.rlike(pattern), value)


def hostname(url) -> Column:
    """Host part of a URL (the referrer hostname expression)."""
    return url_part(url, "hostname")


def trailing_slash(path) -> Column:
    """NULL -> '/', already ending in '/' -> as is, else append '/'."""
    p = _c(path)
    return (F.when(p.isNull(), F.lit("/"))
            .when(F.right(p, F.lit(1)) == F.lit("/"), p)
            .otherwise(F.concat(p, F.lit("/"))))


def clean_page_path(path, clean: Optional[Callable[[Column], Column]] = None) -> Column:
    """Deployer-overridable path cleaner; defaults to :func:`trailing_slash`."""
    return (clean or trailing_slash)(_c(path))


def decode_common_escapes(text) -> Column:
    """Decode the 26 common escapes by ordered replacement.

    ``%25`` is decoded in the middle of the chain, so an escape decoded later
    can be decoded twice (``%252B`` -> ``+``).  Not the same as ``url_decode``.
    """
    out = _c(text)
    for escape, char in COMMON_ESCAPES:
        out = F.replace(out, F.lit(escape), F.lit(char))
    return out
