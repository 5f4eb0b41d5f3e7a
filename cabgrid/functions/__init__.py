from cabgrid.functions.grid import (  # noqa: F401
    DLAT,
    DLON,
    LAST,
    LAT0,
    LON0,
    OUTSIDE_CELL,
    OUTSIDE_INDEX,
    OUTSIDE_ROUTE,
    axis_or_outside,
    bbox_prefilter,
    cell_id,
    cell_of_point,
    cell_or_outside,
    east_index,
    in_grid,
    sql,
    route_of_axes,
    route_of_trip,
    south_index,
)
from cabgrid.functions.timewin import (  # noqa: F401
    time_of_day,
    utc_text,
    utc_wallclock,
    window_end,
    window_start,
)
