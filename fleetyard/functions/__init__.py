"""Column-level helpers: pure Column -> Column functions, all JVM-side."""
from fleetyard.functions.ids import (blank_to_null, branch_of, is_code_in, norm_code,
                                     norm_id, not_blank, reservation_key, strip_zeros)
from fleetyard.functions.dates import (day_slice_id, days_back, render_decimal_ts, sap_date,
                                       window_bounds)
from fleetyard.functions import labels

__all__ = [
    "blank_to_null", "branch_of", "is_code_in", "norm_code", "norm_id", "not_blank",
    "reservation_key", "strip_zeros", "day_slice_id", "days_back", "render_decimal_ts",
    "sap_date", "window_bounds", "labels",
]
