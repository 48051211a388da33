"""Hosts of URLs and link resolution, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- host of a URL, as a column ---------------------------------------------

_BLANKS = "".join(map(chr, range(33)))
_AUTHORITY = (
    r"^(?:(?i:https?|ftp|wss?):[/\\]*|(?i:file):[/\\]{2})"
    r"(?:[^/?#\\]*@)?"  # user name and password
    r"(\[[0-9A-Fa-f:.]+\]|[^/?#\\:\[\]@\x00-\x20<>^|\x7f]+)"
    r"(?::([0-9]*))?(?:[/?#\\]|$)"
)


# Plain ASCII hosts without a user name: nearly all URLs end here.
_PLAIN = r"^(?i:https?|ftp|wss?)://([a-zA-Z0-9._-]+)(?::[0-9]{0,4})?(?:[/?#\\]|$)"


def url_host(url: Column) -> Column:
    """Lower-case host; NULL when the URL does not parse or has no host.

    Port and user name are cut off, ``www.`` stays. International names come
    back in their ASCII form through the JVM's own IDN class, reached only for
    the rows that need it, so no Python worker is involved.
    """
    plain = F.nullif(F.lower(F.regexp_extract(url, _PLAIN, 1)), F.lit(""))
    return F.coalesce(plain, _any_host(url))


def _any_host(url: Column) -> Column:
    clean = F.translate(F.trim(url, F.lit(_BLANKS)), "\t\n\r", "")
    raw = F.regexp_extract(clean, _AUTHORITY, 1)
    port = F.regexp_extract(clean, _AUTHORITY, 2)
    unescaped = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    ascii_host = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), unescaped)
    host = F.when(raw.startswith("["), F.lower(raw)).otherwise(
        F.regexp_extract(F.lower(ascii_host), r"^[^\x00-\x20/?#@:<>^|%\[\]\\\x7f]+$", 0)
    )
    valid_port = (port == "") | F.coalesce(port.try_cast("int") < 65536, F.lit(False))
    return F.when((raw != "") & valid_port & (host != ""), host)


# --- link resolution ---------------------------------------------------------

# Fixed values of the URL standard: schemes with their default ports, and the
# printable ASCII characters each URL part does not leave as they are.
DEFAULT_PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21"}
_ESCAPED_IN = {
    "fragment": '"<>`', "path": '"<>`#?{}', "query": "\"<>#'", "user": "\"<>`#?{}/:;=@[\\]^|", "other": "",
}


def _class_of(part: str) -> str:
    """A character class of what a URL part leaves as it is."""
    kept = [chr(n) for n in range(33, 127) if chr(n) not in _ESCAPED_IN[part]] + ([" "] if part == "other" else [])
    return "[" + "".join("\\" + c if not c.isalnum() else c for c in kept) + "]"


def quoted(text: Column, part: str) -> Column:
    """Characters that a URL part may not hold as percent-encoded UTF-8."""
    kept = _class_of(part)
    encoded = F.transform(
        F.regexp_extract_all(text, F.lit(f"{kept}++|[^{kept[1:]}++"), F.lit(0)),
        lambda run: F.when(run.rlike(f"^{kept}"), run).otherwise(F.regexp_replace(F.hex(F.encode(run, "UTF-8")), "(..)", "%$1")),
    )
    return F.when(text.rlike(rf"^{kept}*+\z"), text).otherwise(F.array_join(encoded, ""))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _tidy(url: Column) -> Column:
    return F.translate(F.trim(url, F.lit(_BLANKS)), "\t\n\r", "")


def _scheme(url: Column) -> Column:
    """Lower-case scheme, empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1))


def _ascii_host(raw: Column) -> Column:
    """Lower-case ASCII form of a host; NULL when it is none."""
    unescaped = F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    ascii_host = F.try_reflect(F.lit("java.net.IDN"), F.lit("toASCII"), unescaped)
    host = F.regexp_extract(F.lower(ascii_host), r"^[^\x00-\x20#/:<>?@\[\\\]^|%\x7f]+$", 0)
    return (
        F.when(raw.rlike(r"^[a-zA-Z0-9._-]+$"), F.lower(raw))
        .when(raw.startswith("["), F.when(raw.endswith("]"), F.lower(raw)))
        .otherwise(F.nullif(host, F.lit("")))
    )


def _network(scheme: Column, authority: Column) -> Column:
    """User, host and port as they stand in a URL; NULL when they cannot."""
    user = F.regexp_extract(authority, "(?s)^(.*)@", 1)
    address = F.regexp_extract(authority, "(?s)([^@]*)$", 1)
    with_port = r"(?s)^(.*):([^\]:]*)$"
    has_port = address.rlike(with_port)
    host = F.when(has_port, F.regexp_extract(address, with_port, 1)).otherwise(address)
    port = F.when(has_port, F.regexp_extract(address, with_port, 2)).otherwise("")
    number = F.when(port.rlike("^[0-9]+$"), port.try_cast("int"))
    valid = (port == "") | F.coalesce(number < 65536, F.lit(False))
    named = F.regexp_replace(F.concat_ws(":", *[
        quoted(part, "user") for part in (F.substring_index(user, ":", 1), F.regexp_extract(user, "(?s)^[^:]*:(.*)$", 1))
    ]), ":+$", "")
    default = F.element_at(F.create_map(*[F.lit(x) for pair in DEFAULT_PORTS.items() for x in pair]), scheme)
    ending = F.when(number.isNull() | (number.cast("string") == F.coalesce(default, F.lit(""))), "").otherwise(
        F.concat(F.lit(":"), number.cast("string"))
    )
    return F.when(valid, F.concat(F.when(named != "", F.concat(named, F.lit("@"))).otherwise(""), _ascii_host(host), ending))


_CLEAN_PATH = r"(?:/(?![.]|%2[eE])[A-Za-z0-9_.~!$&'()*+,;=:@%-]*+)++\z"


def _path(path: Column) -> Column:
    """A path without dot segments, percent-encoded."""
    segments = F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/")
    count = F.size(segments)
    numbered = F.slice(F.transform(segments, lambda s, i: F.struct(s.alias("s"), (i == count - 1).alias("last"))), F.lit(2), F.greatest(count, F.lit(1)))
    empty = F.array(F.lit(""))

    def read(kept: Column, segment: Column) -> Column:
        dots = F.replace(F.lower(segment["s"]), F.lit("%2e"), F.lit("."))
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return (
            F.when(dots == "..", F.when(segment["last"], F.concat(up, empty)).otherwise(up))
            .when(dots == ".", F.when(segment["last"], F.concat(kept, empty)).otherwise(kept))
            .otherwise(F.concat(kept, F.array(quoted(segment["s"], "path"))))
        )

    resolved = F.aggregate(numbered, F.array().cast("array<string>"), read)
    return F.when(path.rlike("^" + _CLEAN_PATH), path).otherwise(F.concat(F.lit("/"), F.array_join(resolved, "/")))


def _query(rest: Column) -> Column:
    """The query with its ``?``, empty if there is none."""
    query = F.regexp_extract(rest, r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(query == "", query).otherwise(F.concat(F.lit("?"), quoted(query.substr(F.lit(2), F.length(query)), "query")))


def _fragment(rest: Column) -> Column:
    """The fragment with its ``#``, empty if there is none."""
    fragment = F.regexp_extract(rest, r"(?s)^[^?#]*(?:\?[^#]*)?(#.*)$", 1)
    return F.when(fragment == "", fragment).otherwise(F.concat(F.lit("#"), quoted(fragment.substr(F.lit(2), F.length(fragment)), "fragment")))


def _absolute(scheme: Column, rest: Column) -> Column:
    """``(scheme, network, path, query)`` of what follows the scheme of a URL with a network part; ``network`` is NULL if it has none."""
    rest = F.regexp_replace(rest, r"^[/\\]+", "")
    authority = F.regexp_extract(rest, r"^[^/\\?#]*", 0)
    tail = rest.substr(F.length(authority) + 1, F.length(rest))
    path = F.regexp_extract(tail, r"(?s)^[^?#]*", 0)
    return F.struct(
        scheme.alias("scheme"), _network(scheme, authority).alias("network"),
        _path(F.when(path == "", "/").otherwise(path)).alias("path"), _query(tail).alias("query"),
    )


def base_url(url: Column) -> Column:
    """A page's own URL, taken apart once to resolve its links; NULL when it is no base."""
    def parsed(tidy: Column) -> Column:
        name = _scheme(tidy)
        base = _absolute(name, tidy.substr(F.length(name) + 2, F.length(tidy)))
        return F.when(name.isin(*DEFAULT_PORTS), _let(base, lambda b: F.when(b["network"].isNotNull(), b)))

    return _let(_tidy(F.coalesce(url, F.lit(""))), parsed)


def resolved_link(href: Column, base: Column) -> Column:
    """A link as an absolute URL; the text itself when it cannot be one."""
    def resolved(link: Column) -> Column:
        own = _scheme(link)
        scheme = F.when(own == "", base["scheme"]).otherwise(own)
        rest = F.when(own == "", link).otherwise(link.substr(F.length(own) + 2, F.length(link)))
        slashes = F.length(F.regexp_extract(rest, r"^[/\\]*", 0))
        elsewhere = _let(
            _absolute(scheme, rest),
            lambda u: F.when(u["network"].isNull(), href).otherwise(
                F.concat(u["scheme"], F.lit("://"), u["network"], u["path"], u["query"], _fragment(rest))
            ),
        )
        path = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
        folder = F.regexp_extract(base["path"], r"(?s)^(.*)/", 1)
        whole = F.when(path == "", base["path"]).when(slashes > 0, _path(path)).otherwise(_path(F.concat(folder, F.lit("/"), path)))
        query = F.when((path == "") & ~rest.startswith("?"), base["query"]).otherwise(_query(rest))
        here = F.concat(base["scheme"], F.lit("://"), base["network"], whole, query, _fragment(rest))
        other = F.concat(own, F.lit(":"), quoted(rest, "other"))
        return (
            F.when((own != "") & ~own.isin(*DEFAULT_PORTS), other)
            .when((slashes >= 2) | (scheme != base["scheme"]), elsewhere).otherwise(here)
        )

    # most links are clean paths on the same host
    same_host = F.concat(base["scheme"], F.lit("://"), base["network"], href)
    return F.when(href.rlike("^(?!//)" + _CLEAN_PATH), same_host).otherwise(_let(_tidy(href), resolved))


def page_links(url: Column, hrefs: Column) -> Column:
    """Links in page order, repeats kept; NULL when there are none or the page's URL is no base."""
    def resolved(given: Column) -> Column:
        links = F.transform(given["hrefs"], lambda h: resolved_link(h, given["base"]))
        return F.when(given["base"].isNotNull() & (F.size(given["hrefs"]) > 0), links)

    return _let(F.struct(base_url(url).alias("base"), hrefs.alias("hrefs")), resolved)
