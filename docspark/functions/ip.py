"""IP address keys (the ``ip`` field type and ``ip_range``, G6).

An address is stored as its string plus a 16-byte sort key: IPv6 bytes, with IPv4 mapped into ``::ffff:0:0/96``.
Everything here is a Spark expression; CIDR bounds are computed on the driver from the (small) range list.
"""

from __future__ import annotations

import ipaddress

from pyspark.sql import Column, functions as F

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4_RX = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
_V4_TAIL = r"(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})$"


def _v4_hex(s: Column) -> Column:
    parts = F.split(s, r"\.")
    return F.concat(*[F.lpad(F.hex(parts[i].cast("int")), 2, "0") for i in range(4)])


def ipv4_key(s: Column) -> Column:
    return F.when(s.rlike(IPV4_RX), F.unhex(F.concat(F.lit("00000000000000000000FFFF"), _v4_hex(s))))


def ipv6_key(s: Column) -> Column:
    """Expand ``::`` and an embedded dotted IPv4 tail, validate, and return the 16 bytes (null if invalid)."""
    low = F.lower(s)
    tail = F.regexp_extract(low, _V4_TAIL, 1)
    tail_ok = (tail == "") | tail.rlike(IPV4_RX)
    tail_hex = F.lower(_v4_hex(tail))
    tail_groups = F.concat(F.substring(tail_hex, 1, 4), F.lit(":"), F.substring(tail_hex, 5, 4))
    body = F.when(tail != "", F.concat(F.regexp_replace(low, _V4_TAIL, ""), tail_groups)).otherwise(low)
    halves = F.split(body, "::", -1)
    n_halves = F.size(halves)

    def groups(part: Column) -> Column:
        return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ":", -1))

    left = groups(halves[0])
    right = F.when(n_halves == 2, groups(halves[1])).otherwise(F.array().cast("array<string>"))
    missing = F.lit(8) - F.size(left) - F.size(right)
    full = F.when(n_halves == 2, F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)) \
        .otherwise(left)
    valid = (tail_ok & (n_halves <= 2) & ((n_halves == 1) | (missing >= 1)) & (F.size(full) == 8)
             & F.forall(full, lambda g: g.rlike(r"^[0-9a-f]{1,4}$")))
    hexs = F.array_join(F.transform(full, lambda g: F.lpad(g, 4, "0")), "")
    return F.when(s.contains(":") & valid, F.unhex(hexs))


def ip_key(s: Column) -> Column:
    """16-byte key of an IPv4 or IPv6 string; null when the string is not an address."""
    t = F.trim(s)
    return F.when(t.contains(":"), ipv6_key(t)).otherwise(ipv4_key(t))


def key_bytes(addr: str) -> bytes:
    """Driver-side key of one literal address (for range bounds)."""
    ip = ipaddress.ip_address(addr)
    if ip.version == 4:
        ip = ipaddress.IPv6Address("::ffff:" + str(ip))
    return ip.packed


def cidr_bounds(mask: str) -> tuple[bytes, bytes | None]:
    """``[from, to)`` keys of a CIDR block; ``to`` is None when the block ends at the top of the space."""
    net = ipaddress.ip_network(mask, strict=False)
    first = key_bytes(str(net.network_address))
    last = int.from_bytes(key_bytes(str(net.broadcast_address)), "big")
    if last + 1 >= 1 << 128:
        return first, None
    return first, (last + 1).to_bytes(16, "big")


def key_to_string(b: bytes) -> str:
    ip = ipaddress.IPv6Address(b)
    return str(ip.ipv4_mapped) if ip.ipv4_mapped is not None else str(ip)
