"""Names, wire constants and argument checks shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

SUCCESS = "success"
FAILURE = "failure"
ERROR = "error"

# The attribute names every flow may carry by convention.
CORE_ATTRIBUTES = (
    "path",
    "absolute.path",
    "filename",
    "uuid",
    "priority",
    "mime.type",
    "discard.reason",
    "alternate.identifier",
)

# Datagrams are identified by their sender and the sender's running flow number.
FLOW_KEY = ("source", "flow_id")

# Counters are grouped into blocks of this many before they are ordered, so that one
# huge flow is spread over many tasks.
COUNTER_BLOCK = 4096

# A flow larger than this is not built into one cell; read it with output="chunks".
MAX_BLOB_BYTES = 256 * 1024 * 1024

# Receivers cut datagrams at this size, so no piece is longer.
MAX_PACKET_BYTES = 1500


@dataclass(frozen=True)
class DatagramProfile:
    """Wire sizes of one datagram layout."""

    first_header: int  # bytes before the attribute header in the first datagram
    data_header: int  # bytes before the data in the others
    network_header: int  # IP + UDP bytes kept free
    counter_bytes: int
    announces_first: bool  # does the announced total count the first datagram?


# Datagram layouts.
DATAGRAM_PROFILES = {
    "v0": DatagramProfile(24, 16, 28, 8, True),
    "legacy": DatagramProfile(24, 12, 0, 4, False),
}
LEGACY_DATAGRAM_SIZE = 1450

# Framed stream layouts -> leading int32 version field, or none.
FRAME_VERSIONS = {"v2": None, "v0": 0, "legacy": 1}


def datagram_profile(name: str) -> DatagramProfile:
    if name not in DATAGRAM_PROFILES:
        raise ValueError(f"unknown datagram profile {name!r}, expected one of {sorted(DATAGRAM_PROFILES)}")
    return DATAGRAM_PROFILES[name]


def frame_prefix_bytes(profile: str) -> int:
    """Bytes before the attribute header of a frame."""
    if profile not in FRAME_VERSIONS:
        raise ValueError(f"unknown frame profile {profile!r}, expected one of {sorted(FRAME_VERSIONS)}")
    return 12 if FRAME_VERSIONS[profile] is None else 16


def check_port(port: int) -> int:
    if not 1 <= int(port) <= 65535:
        raise ValueError(f"port must be in 1..65535, got {port}")
    return int(port)
