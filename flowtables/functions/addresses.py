"""IPv4 addresses as numbers, and allow-lists as number ranges."""

from __future__ import annotations

import ipaddress
from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IPV4 = rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z"


def ipv4_number(address: Column) -> Column:
    """Address as bigint; null unless it is a dotted quad."""
    parts = F.split(address, r"\.")
    number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, part: n * 256 + part.cast("bigint"))
    return F.when(address.rlike(_IPV4), number)


def parse_allowlist(allowlist: str) -> tuple[list[tuple[int, int]], list[str]]:
    """Inclusive (low, high) ranges of the CIDR entries, and the plain entries. Raises on a malformed entry."""
    ranges, exact = [], []
    for entry in (e.strip() for e in allowlist.split(",")):
        if not entry:
            continue
        if "/" in entry:
            block = ipaddress.IPv4Network(entry, strict=False)
            ranges.append((int(block.network_address), int(block.broadcast_address)))
        else:
            ipaddress.ip_address(entry)
            exact.append(entry)
    return ranges, exact


def parse_allowlist_compat(allowlist: str) -> tuple[list[tuple[int, int]], list[str]]:
    """The older rule: no trimming, entries after a malformed block are lost, blocks admit inner hosts only."""
    ranges, exact = [], []
    for entry in allowlist.split(","):
        if "/" not in entry:
            exact.append(entry)
            continue
        try:
            block = ipaddress.IPv4Network(entry, strict=False)
        except ValueError:
            break
        if block.prefixlen < 31:
            ranges.append((int(block.network_address) + 1, int(block.broadcast_address) - 1))
    return ranges, exact


def in_ranges(number: Column, ranges: list[tuple[int, int]]) -> Column:
    """Is the number in any of the ranges?

    The ranges are merged and written as aligned blocks, so the test is one hash lookup per
    distinct block size (at most 33), however long the list is.
    """
    prefixes = defaultdict(set)
    addresses = (
        ipaddress.summarize_address_range(ipaddress.IPv4Address(lo), ipaddress.IPv4Address(hi)) for lo, hi in ranges
    )
    for block in ipaddress.collapse_addresses(b for blocks in addresses for b in blocks):
        prefixes[block.prefixlen].add(int(block.network_address) >> (32 - block.prefixlen))

    def hit(n: Column) -> Column:
        found = F.lit(False)
        for length, values in sorted(prefixes.items()):
            found = found | F.shiftright(n, 32 - length).isin(sorted(values))
        return found

    # As a lambda's argument the number is worked out once, not once per block size.
    return F.coalesce(F.exists(F.array(number), hit), F.lit(False))
