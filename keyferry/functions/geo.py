"""Point geometry in extended well-known binary (hex text) to plain WKB plus its SRID."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import clean_str

# Byte layout of a 2-D EWKB point, little and big endian, with and without SRID.
LITTLE_WITH_SRID = "^0101000020[0-9A-F]{40}$"
LITTLE_PLAIN = "^0101000000[0-9A-F]{32}$"
BIG_WITH_SRID = "^0020000001[0-9A-F]{40}$"
BIG_PLAIN = "^0000000001[0-9A-F]{32}$"


def ewkb_to_wkb(c: Column) -> Column:
    """Struct(srid, wkb); null for null, blank or malformed input."""
    h = F.upper(clean_str(c))
    swapped = F.concat(h.substr(17, 2), h.substr(15, 2), h.substr(13, 2), h.substr(11, 2))
    hexint = lambda x: F.conv(x, 16, 10).try_cast("int")
    srid = F.when(h.rlike(LITTLE_WITH_SRID), hexint(swapped)).when(
        h.rlike(BIG_WITH_SRID), hexint(h.substr(11, 8))
    )
    wkb = (
        F.when(h.rlike(LITTLE_WITH_SRID), F.concat(F.lit("0101000000"), h.substr(19, 32)))
        .when(h.rlike(BIG_WITH_SRID), F.concat(F.lit("0000000001"), h.substr(19, 32)))
        .when(h.rlike(LITTLE_PLAIN) | h.rlike(BIG_PLAIN), h)
    )
    return F.when(wkb.isNotNull(), F.struct(srid.alias("srid"), F.unhex(wkb).alias("wkb")))
