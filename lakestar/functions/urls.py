"""URL identity as Column expressions: normalised addresses, hashes and tiers, without Python on the executors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters besides letters, digits and -._~ that stay as they are in a path, and in a part of a query.
PATH_SAFE, QUERY_SAFE = "/:@!$&'()*+,;=", "/:?@!$'()*+,"
#: scheme, user and host with port, path, query; without a host it doesn't fit. A fragment is left out.
_ADDRESS = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Host, which may be an IPv6 address in brackets, and port behind the last @.
_HOST = r"^(?:.*@)?(\[[^\[\]@]+\]|[^:@\[\]]+)(?::([0-9]*))?$"


def _plain(c: Column, safe: str) -> Column:
    return c.rlike("^[A-Za-z0-9\\-._~" + "".join(f"\\{x}" for x in safe) + "]*$")


def decoded(c: Column) -> Column:
    """Percent-encoding undone once, as UTF-8; what isn't one stays, a plus is a plus."""
    return F.try_url_decode(F.replace(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")))


def encoded(c: Column, safe: str) -> Column:
    """All but letters, digits, -._~ and ``safe`` percent-encoded, as UTF-8."""
    # Spark encodes as forms do: a blank is a plus, and of the safe characters only * stays.
    out = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return reduce(lambda a, x: F.replace(a, F.lit(f"%{ord(x):02X}"), F.lit(x)), (x for x in safe + "~" if x != "*"), out)


def _once(c: Column, safe: str, strip: bool = False) -> Column:
    """Decoded once and encoded again, without slashes at the end if ``strip``; most texts need neither."""
    cut = (lambda x: F.regexp_replace(x, "/+$", "")) if strip else lambda x: x
    return F.when(_plain(c, safe), cut(c)).otherwise(encoded(cut(decoded(c)), safe))


def _query(c: Column) -> Column:
    """Each key and value by itself, so that an encoded separator stays one that is encoded."""

    def part(x: Column) -> Column:
        at = F.instr(x, "=")
        key, value = F.when(at > 0, F.substring(x, F.lit(1), at - 1)).otherwise(x), F.substring(x, at + 1, F.length(x))
        return F.when(x.isin("&", ";"), x).otherwise(F.concat(_once(key, QUERY_SAFE), F.when(at > 0, F.concat(F.lit("="), _once(value, QUERY_SAFE))).otherwise("")))

    return F.when(_plain(c, QUERY_SAFE + "&"), c).otherwise(F.array_join(F.transform(F.split(c, "(?<=[&;])|(?=[&;])"), part), ""))


def normalize_url(c: Column, aliases: dict[str, str] | None = None, drop_query: str | None = None, strict: bool = False) -> Column:
    """https, lower-case host (``aliases`` applied), no port 80 or 443, no fragment, no closing slash, percent-encoding decided once.

    ``drop_query``: pattern of host and path whose query names no other page. Null for what is null, blank, without a host
    or with a bad port; an error with ``strict``.
    """
    url = F.regexp_replace(F.regexp_replace(c, "[\t\r\n]", ""), r"^[\s\x00-\x20]+|\s+$", "")
    there = F.regexp_extract(url, _ADDRESS, 1)
    port = F.regexp_extract(there, _HOST, 2)
    host = F.lower(F.regexp_extract(there, _HOST, 1))
    host = reduce(lambda a, x: a.when(host == x[0], x[1].lower()), (aliases or {}).items(), F).otherwise(host) if aliases else host
    number = port.try_cast("int")
    site = F.concat(host, F.when((port == "") | number.isin(80, 443), "").otherwise(F.concat(F.lit(":"), number.cast("string"))))
    path = _once(F.regexp_extract(url, _ADDRESS, 2), PATH_SAFE, strip=True)
    query = F.regexp_extract(url, _ADDRESS, 3)
    tail = F.when(query == "", "").otherwise(F.concat(F.lit("?"), _query(query)))
    if drop_query:
        tail = F.when(F.concat(site, path).rlike(drop_query), "").otherwise(tail)
    good = (host != "") & ((port == "") | (F.length(port) < 10) & (number <= 65535))
    bad = F.raise_error(F.concat(F.lit("not an address: "), F.coalesce(c, F.lit("null")))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(good, F.concat(F.lit("https://"), site, path, tail)).otherwise(bad)


def plain_identity(c: Column) -> Column:
    """A coarser identity: scheme, www./m. alias, query, fragment and closing slash gone, nothing decoded."""
    out = F.regexp_replace(F.trim(c), r"[?#].*$", "")
    out = F.regexp_replace(out, r"^[A-Za-z]+://", "https://")
    out = F.regexp_replace(out, r"^https://(www|m)\.", "https://")
    return F.regexp_replace(out, "/+$", "")


def url_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def url_type(c: Column, patterns: dict[str, str], strict: bool = False) -> Column:
    """The first pattern that fits; else null, or an error if ``strict``."""
    out = F
    for kind, pattern in patterns.items():
        out = out.when(c.rlike(pattern), kind)
    return out.otherwise(F.raise_error(F.concat(F.lit("unclassifiable url: "), c))) if strict else out
