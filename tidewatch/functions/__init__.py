"""Column-level helpers: every one returns a built-in Spark expression."""

from tidewatch.functions.time import (  # noqa: F401
    ceil_to_grid_micros, iso_to_ntz, micros_to_ntz, millis_to_ntz, ntz_micros,
    partition_parts,
)
from tidewatch.functions.casts import (  # noqa: F401
    snapshot_asset, to_decimal, trade_asset,
)
