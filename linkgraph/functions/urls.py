"""URLs as column expressions: parts, syntax test, resolution and traps.

Every function builds native expressions, so they stay in generated code, and the patterns use only
what both Java and RE2 understand. The accept and reject sets were checked against the JDK's own
``URI`` and ``URL`` classes.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# URL grammar. Links may have the schemes http, https, ftp, file, mailto and jar; a
# crawler fetches http and https.
SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?([^?#]*)"
# Ports up to the greatest 32-bit number, with any leading zeros.
PORT = (r"-1|0*(?:[0-9]{0,9}|1[0-9]{9}|20[0-9]{8}|21[0-3][0-9]{7}|214[0-6][0-9]{6}|2147[0-3][0-9]{5}"
        r"|21474[0-7][0-9]{4}|214748[0-2][0-9]{3}|2147483[0-5][0-9]{2}|21474836[0-3][0-9]|214748364[0-7])")
LINK_URL = (
    r"^(?i:https?|ftp|file):(?:/?(?:[^/]|$)"
    r"|//(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:]*)(?::(?:" + PORT + r"))?(?:[/?#]|$))"
    r"|^(?i:mailto):|^(?i:jar):.*!/")
WEB_URL = r"^(?i:https?):"
IPV6_HOST = r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@\[\]]*@)?)\[[0-9A-Fa-f:.]+\]"
URL_PREFIX = r"^(?i:url):"
EMPTY_AUTHORITY = r"^([a-z]+)://([?#]|/(?:[^/]|$))"

# Each of these, found anywhere in a link, makes it ill-formed.
ILL_FORMED = "|".join((
    r'[\x00-\x20\x7f-\x{9f}\p{Z}"<>\\^`{|}]',                      # a character that must be escaped
    r"%(?:[^0-9A-Fa-f]|$|[0-9A-Fa-f](?:[^0-9A-Fa-f]|$))",          # a broken escape
    r"#[^#]*#",                                                    # a second fragment
    r"^[A-Za-z][A-Za-z0-9+.-]*:(?:$|#)",                           # a scheme and nothing else
    r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//$",                          # no authority and no path
    r"^(?:[^A-Za-z/?#:][^/?#:]*)?:",                               # a bad start of a scheme
    r"^[^/?#:]*[^A-Za-z0-9+./?#:-][^/?#:]*:",                      # a bad character in a scheme
))
BRACKET_BEFORE_QUERY = r"^[^?#]*[\[\]]"
OPAQUE = r"^[A-Za-z][A-Za-z0-9+.-]*:[^/]"


def scheme_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def host_of(url: Column) -> Column:
    """Host without user info and port, case kept; empty for URLs such as ``mailto:``."""
    return F.regexp_extract(url, HOST, 1)


def path_of(url: Column) -> Column:
    """Path without query and fragment."""
    return F.regexp_extract(url, PATH, 1)


def url_parts(url: Column) -> Column:
    return F.struct(
        scheme_of(url).alias("protocol"), host_of(url).alias("host"), path_of(url).alias("path"))


def is_legal(link: Column) -> Column:
    """Whether ``link`` has legal URI syntax (relative links included)."""
    outside_host = F.regexp_replace(link, IPV6_HOST, "$1").rlike(BRACKET_BEFORE_QUERY)
    return ~(link.rlike(ILL_FORMED) | (link.contains("[") | link.contains("]")) & outside_host
             & ~link.rlike(OPAQUE))


def canonical_url(link: Column) -> Column:
    """A well-formed absolute link with its scheme lowered; NULL for a scheme or port not known."""
    lowered = F.concat(F.lower(F.substring_index(link, ":", 1)), F.substr(link, F.instr(link, ":")))
    return F.when(link.rlike(LINK_URL), F.regexp_replace(lowered, EMPTY_AUTHORITY, "$1:$2"))


def absolute_url(link: Column) -> Column:
    """``link`` in canonical form if it is a usable absolute URL, else NULL."""
    return F.when(is_legal(link), canonical_url(F.regexp_replace(link, URL_PREFIX, "")))


def base_directory(path: Column) -> Column:
    """The directory relative links start from.

    A last segment with a dot is a file and is cut; one without is taken as a directory.
    """
    cut = F.when(F.substring_index(path, "/", -1).contains("."),
                 F.trim(F.regexp_replace(path, r"/[^/]*$", ""))).otherwise(path)
    full = F.when(F.trim(path) == "", "/").otherwise(cut)
    return F.when(full.endswith("/"), full).otherwise(F.concat(full, F.lit("/")))


def joined_url(href: Column, proto: Column, host: Column, path: Column) -> Column:
    """``href`` made absolute; NULL if it is ill-formed."""
    site = F.concat(proto, F.lit("://"), host)
    full = (
        F.when(href.startswith("//"), F.concat(proto, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(site, href))
        .when(href.rlike(SCHEME), F.regexp_replace(href, URL_PREFIX, ""))
        .otherwise(F.concat(site, base_directory(path), href)))
    return F.when(is_legal(href), full)


def resolve_url(href: Column, proto: Column, host: Column, path: Column) -> Column:
    """Resolve ``href`` against a page; NULL when the result is no usable URL.

    Dot segments are kept as they are, see ``dotdot_count``.
    """
    return canonical_url(joined_url(href, proto, host, path))


def resolve_urls(hrefs: Column, proto: Column, host: Column, path: Column) -> Column:
    """Resolve an array of hrefs of one page; those that give no usable URL are left out."""
    full = F.transform(hrefs, lambda href: joined_url(href, proto, host, path))
    return F.filter(F.transform(full, canonical_url), lambda link: link.isNotNull())


def is_web_url(url: Column) -> Column:
    """Whether a crawler can fetch ``url``."""
    return url.rlike(WEB_URL)


def dotdot_count(url: Column) -> Column:
    """Non-overlapping occurrences of ``..``."""
    return F.floor((F.length(url) - F.length(F.replace(url, F.lit(".."), F.lit("")))) / 2)
