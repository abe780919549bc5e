from fleetlens.functions.columns import (
    round_half_even, snap_limit, label_band, curve_overspeed, curve_nonsevere, curve_ecs,
    curve_cmb, curve_esprsp, event_code, batch_start, week_end, seconds_between, quantize,
)

__all__ = [
    "round_half_even", "snap_limit", "label_band", "curve_overspeed", "curve_nonsevere",
    "curve_ecs", "curve_cmb", "curve_esprsp", "event_code", "batch_start", "week_end",
    "seconds_between", "quantize",
]
