"""Column -> Column functions. All are built-in expressions; none is a Python UDF."""

from gridagro.functions.agroclimate import (
    degree_day,
    et0_rhum,
    et0_tdew,
    kelvin_to_celsius,
    ra,
    saturation_pressure,
    tmean,
)
from gridagro.functions.dates import (
    Window,
    calendar_parts,
    day_of,
    doy_from_sim_year,
    end_day,
    end_year,
    fixed_window,
    in_season,
    is_leap,
    season_year,
    sowing_window,
    start_day,
    to_day,
    year_length,
)
from gridagro.functions.ids import (
    TEXTURE_CLASSES,
    cell_mangt_id,
    in_scenario,
    map_variety,
    parse_file_name,
    parse_output_name,
    parse_sim_id,
    point_id,
    scenario_of,
    sim_id,
    sown_mangt_id,
    texture_name,
    weather_key,
)
from gridagro.functions.layout import z_key
from gridagro.functions.numeric import (
    as_float,
    fill_in_mask,
    kg_to_t,
    nan_to_null,
    round_half_even,
    snap,
    strict_cast,
    trunc_int,
)

__all__ = [name for name in dir() if not name.startswith("_")]
