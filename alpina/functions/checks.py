"""Content checks on binary/text payloads: SHA-256 multihash and GeoTIFF magic bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def verify_checksum(content, checksum) -> Column:
    """TRUE when the checksum is a sha2-256 multihash (``1220`` + hex digest) equal to the
    content's digest, in lower case as it is written; FALSE on mismatch; NULL (not checked) for other prefixes or no checksum."""
    content, checksum = _col(content), _col(checksum)
    digest = F.sha2(content, 256)
    n = len(SHA256_MULTIHASH_PREFIX)
    return F.when(checksum.startswith(SHA256_MULTIHASH_PREFIX), F.concat(F.lit(SHA256_MULTIHASH_PREFIX), digest) == checksum)


from alpina.fixed_values import SHA256_MULTIHASH_PREFIX, TIFF_MAGIC_HEX  # noqa: E402


def sniff_magic(content, magics_hex=TIFF_MAGIC_HEX) -> Column:
    """First four bytes of a binary column are one of the accepted signatures."""
    head = F.hex(F.substring(_col(content), 1, 4))
    return head.isin(list(magics_hex))
