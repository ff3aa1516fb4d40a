"""Host of a referer, extension of a requested path."""

from __future__ import annotations

from string import ascii_letters, digits

from pyspark.sql import Column, functions as F

from loglode.functions.text import request_target

# The classes list their members one by one, which the regex engine turns into a bit table.
SCHEME = ascii_letters + digits + "+.\\-"
USER_INFO = ascii_letters + digits + "\\-._:~!$&'()*+,;=%@"
CONTROLS = "".join(f"\\x{code:02x}" for code in [*range(0x20), 0x7F])
NOT_IN_NAME = CONTROLS + " #%/:?@^`{|}" + "\\[\\]\\\\"

# scheme, //, user info, then a bracketed address or a name, a port, and the rest. Anything else
# has no host.
HOST = (
    f"^(?:[{ascii_letters}][{SCHEME}]*:)?//(?:[{USER_INFO}]*@)?"
    rf"(\[[^\]]*\]|[^{NOT_IN_NAME}]*)(?::[{digits}]*)?(?=[/?#]|$)[^{CONTROLS}]*$"
)
BAD_ESCAPE = "%(?![0-9A-Fa-f]{2})"


def url_host(url: Column) -> Column:
    """Host name without port; ``''`` for a missing, local or malformed address."""
    url = F.coalesce(url, F.lit(""))
    host = F.btrim(F.regexp_extract(url, HOST, 1), F.lit("[]"))
    # The query may hold any text; a stray percent sign elsewhere makes the address invalid.
    without_query = F.regexp_replace(url, r"^([^#?]*)\?[^#]*", "$1")
    malformed = F.contains(url, F.lit("%")) & without_query.rlike(BAD_ESCAPE)
    return F.when(malformed, "").otherwise(host)


def path_extension(target: Column) -> Column:
    """Lower-case text after the last dot of the last path segment, without query or fragment."""
    path = F.substring_index(F.substring_index(F.coalesce(target, F.lit("")), "?", 1), "#", 1)
    segment = F.substring_index(path, "/", -1)
    return F.when(
        F.contains(segment, F.lit(".")), F.lower(F.substring_index(segment, ".", -1))
    ).otherwise("")


def request_extension(request: Column) -> Column:
    return path_extension(request_target(request))
