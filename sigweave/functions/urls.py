"""URL expressions."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Query parameters that only track.
TRACKING = ["fbclid", "gclid", "igshid", "mc_cid", "mc_eid", "ref", "source", "spm", "utm_campaign", "utm_content", "utm_medium", "utm_source", "utm_term"]
# Labels that make a compound top-level domain.
COMPOUND = ["co", "com", "org", "net", "gov", "ac", "edu"]


def host(c: Column) -> Column:
    return F.lower(F.try_parse_url(c, F.lit("HOST")))


def canonical_url(c: Column) -> Column:
    """Null for what isn't http or https. Lower-case scheme and host, no default port, fragment or tracking
    parameter, parameters in order of name (equal names keep theirs), no slash at the end of a longer path."""
    scheme = F.lower(F.try_parse_url(c, F.lit("PROTOCOL")))
    authority = F.lower(F.try_parse_url(c, F.lit("AUTHORITY")))
    authority = F.regexp_replace(authority, F.when(scheme == "https", F.lit(":443$")).otherwise(F.lit(":80$")), F.lit(""))
    path = F.coalesce(F.try_parse_url(c, F.lit("PATH")), F.lit(""))
    path = F.when(F.length(path) > 1, F.regexp_replace(path, "/+$", "")).otherwise(path)
    path = F.when(path == "", F.lit("/")).otherwise(path)
    parts = F.filter(F.split(F.coalesce(F.try_parse_url(c, F.lit("QUERY")), F.lit("")), "&"), lambda p: p != "")
    named = F.transform(parts, lambda p, i: F.struct(F.split_part(p, F.lit("="), F.lit(1)).alias("key"), i.alias("at"), p.alias("part")))
    kept = F.sort_array(F.filter(named, lambda p: ~F.lower(p["key"]).isin(TRACKING)))
    query = F.array_join(F.transform(kept, lambda p: p["part"]), "&")
    whole = F.concat(scheme, F.lit("://"), authority, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(scheme.isin("http", "https"), whole)


def dedup_key(external_id: Column, url: Column, title: Column) -> Column:
    return F.coalesce(F.nullif(external_id, F.lit("")), F.nullif(F.coalesce(canonical_url(url), url), F.lit("")), F.nullif(title, F.lit("")))


def core_label(name: Column) -> Column:
    """The label that carries the brand: that before the top-level domain, compound ones skipped."""
    parts = F.filter(F.split(name, r"\."), lambda p: p != "")
    second = F.try_element_at(parts, F.lit(-2))
    compound = (F.size(parts) >= 3) & second.isin(COMPOUND)
    return F.coalesce(F.when(compound, F.try_element_at(parts, F.lit(-3))).otherwise(second), name)


def same_brand(a: Column, b: Column) -> Column:
    x, y = core_label(a), core_label(b)
    return x.contains(y) | y.contains(x)


def resolve(value: Column | str, base: Column | str) -> Column:
    """Absolute http or https url of a reference on a page, else null. Dot segments of relative references go."""
    v, b = (F.col(c) if isinstance(c, str) else c for c in (value, base))
    v = F.trim(F.regexp_replace(v, r"[\t\n\r]|^[\x00-\x20]+|[\x00-\x20]+$", ""))
    whole = r"^([A-Za-z][A-Za-z0-9+.-]*:)(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"
    part = lambda n: F.regexp_extract(b, whole, n)
    path = F.regexp_extract(v, r"^([^?#]*)", 1)
    rest = F.substr(v, F.length(path) + 1)
    joined = F.when(path.startswith("/"), path).when(path == "", part(3)).otherwise(F.concat(F.regexp_extract(F.concat(F.lit("/"), F.regexp_replace(part(3), "^/", "")), "^(.*/)", 1), path))
    query = F.when((path == "") & ~rest.startswith("?"), F.concat(part(4), rest)).otherwise(rest)
    relative = F.concat(part(1), F.lit("//"), part(2), F.when(path == "", joined).otherwise(without_dots(joined)), query)
    out = F.when(v.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), v).when(v.startswith("//"), F.concat(part(1), v)).otherwise(relative)
    return F.when((v != "") & out.rlike("(?i)^https?://[^/?#]"), out)


def without_dots(path: Column) -> Column:
    """A path that begins with a slash, `.` and `..` worked off."""
    none = F.array().cast("array<string>")
    step = lambda acc, s: F.when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(s == ".", acc).otherwise(F.concat(acc, F.array(s)))
    last = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    parts = F.split(F.substr(path, F.lit(2)), "/")
    kept = F.array_join(F.aggregate(parts, none, step), "/")
    return F.when(path.rlike(r"/\.{1,2}(?:/|$)"), F.concat(F.lit("/"), kept, F.when(kept == "", F.lit("")).otherwise(last))).otherwise(path)


def private(address: str | None) -> bool:
    try:
        ip = ipaddress.ip_address((address or "").strip("[]").split("%")[0])
    except ValueError:
        return (address or "").lower() == "localhost"
    return ip.is_private or ip.is_loopback or ip.is_link_local or ip.is_unspecified or ip.is_multicast or ip.is_reserved


@F.pandas_udf(T.BooleanType())
def is_private(address: pd.Series) -> pd.Series:
    """Addresses that a fetch must not reach."""
    return address.map(private)


def safe_url(c: Column) -> Column:
    """http(s), without credentials, not at a private address by its host."""
    authority = F.coalesce(F.try_parse_url(c, F.lit("AUTHORITY")), F.lit(""))
    return F.lower(F.try_parse_url(c, F.lit("PROTOCOL"))).isin("http", "https") & ~authority.contains("@") & ~is_private(host(c))


def redact(c: Column) -> Column:
    return F.regexp_replace(c, r"//[^/@\s]+@", "//***@")
