"""URLs, user agents and IP addresses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def browser(user_agent: Column) -> Column:
    """Browser family; NULL or empty gives NULL. The tests run in this order."""
    ua = F.lower(user_agent)
    edge, opera = ua.contains("edg"), ua.contains("opr") | ua.contains("opera")
    chrome, safari = ua.contains("chrome"), ua.contains("safari")
    return (
        F.when(user_agent.isNull() | (user_agent == ""), None)
        .when(chrome & safari, F.when(edge, "Edge").when(opera, "Opera").otherwise("Chrome"))
        .when(ua.contains("firefox"), "Firefox")
        .when(safari, "Safari")
        .when(edge, "Edge")
        .when(opera, "Opera")
        .when(ua.contains("msie") | ua.contains("trident"), "Internet Explorer")
        .otherwise("Other")
    )


def operating_system(user_agent: Column) -> Column:
    """System family. macOS is tested before iOS and Linux before Android, so iPhones count
    as macOS and Android phones as Linux."""
    ua = F.lower(user_agent)
    return (
        F.when(user_agent.isNull() | (user_agent == ""), None)
        .when(ua.contains("windows"), "Windows")
        .when(ua.contains("mac os x") | ua.contains("macos"), "macOS")
        .when(ua.contains("linux"), "Linux")
        .when(ua.contains("android"), "Android")
        .when(ua.contains("iphone") | ua.contains("ipad") | ua.contains("ipod"), "iOS")
        .when(ua.contains("cros"), "Chrome OS")
        .otherwise("Other")
    )


def authority(url: Column) -> Column:
    """Host with any port; the scheme may be missing. Nothing usable gives NULL."""
    full = F.when(url.contains("//"), url).otherwise(F.concat(F.lit("http://"), url))
    net = F.regexp_extract(full, r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    unbalanced = net.contains("[") != net.contains("]")
    return F.when((F.trim(url) != "") & (net != "") & ~unbalanced, net)


def canonical_page(url: Column) -> Column:
    """The URL up to and including '.html', without its query."""
    return F.concat(F.substring_index(F.substring_index(url, "?", 1), ".html", 1), F.lit(".html"))


def is_product_page(url: Column, site_prefix: str) -> Column:
    return url.startswith(site_prefix) & url.contains(".html")


def domain_suffix(url: Column) -> Column:
    """Last label of the host, which stands for the country of a shop."""
    host = F.regexp_replace(authority(url), r":\d+$", "")
    return F.nullif(F.substring_index(host, ".", -1), F.lit(""))


def ipv4_number(ip: Column) -> Column:
    """Dotted address as a whole number; anything else gives NULL."""
    parts = F.split(ip, r"\.")
    bytes_ = [F.get(parts, i).try_cast("bigint") for i in range(4)]
    total = bytes_[0]
    for part in bytes_[1:]:
        total = total * 256 + part
    shape = ip.rlike(r"^\d{1,3}(\.\d{1,3}){3}$")
    in_range = bytes_[0].between(0, 255)
    for part in bytes_[1:]:
        in_range = in_range & part.between(0, 255)
    return F.when(shape & in_range, total)


_HEX_GROUP = r"[0-9A-Fa-f]{1,4}"


def address_key(ip: Column) -> Column:
    """32 hex digits that sort like the address, for IPv4 (as ``::ffff:a.b.c.d``) and IPv6; NULL for other text."""
    four = ipv4_number(ip)
    mapped = F.concat(F.lit("00000000000000000000ffff"), F.lower(F.lpad(F.hex(four), 8, "0")))
    # an IPv4 tail is two groups
    tail = F.regexp_extract(ip, r"^[0-9A-Fa-f:]*:(\d+\.\d+\.\d+\.\d+)$", 1)
    tail_hex = F.lower(F.lpad(F.hex(ipv4_number(tail)), 8, "0"))
    text = F.when(tail == "", ip).otherwise(
        F.concat(F.substring(ip, F.lit(1), F.length(ip) - F.length(tail)), F.substring(tail_hex, 1, 4), F.lit(":"), F.substring(tail_hex, 5, 4))
    )
    sides = F.split(text, "::", -1)
    groups = lambda side: F.filter(F.split(side, ":", -1), lambda g: g != "")
    left, right = groups(F.get(sides, 0)), groups(F.coalesce(F.get(sides, 1), F.lit("")))
    missing = 8 - F.size(left) - F.size(right)
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.when(F.size(sides) == 2, missing).otherwise(0)), right)
    whole = F.lower(F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))
    single = rf"^({_HEX_GROUP}(:{_HEX_GROUP})*)?(::({_HEX_GROUP}(:{_HEX_GROUP})*)?)?$"
    sound = text.rlike(single) & text.contains(":") & (F.size(filled) == 8) & ((F.size(sides) == 1) | (missing > 0))
    return F.when(four.isNotNull(), mapped).when(sound, whole)
