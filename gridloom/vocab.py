"""Vocabularies."""

from __future__ import annotations

# Units by metric.
UNIT_FOR_METRIC = {
    "watts": "W", "amps": "A", "volts": "V", "hz": "Hz", "indoor_temp_f": "degF", "outdoor_temp_f": "degF", "setpoint_cool_f": "degF", "setpoint_heat_f": "degF",
    "humidity_pct": "pct", "stage": "enum", "stage_pct": "pct", "mode": "enum", "fan": "enum", "blower_rpm": "rpm", "cfm": "cfm", "compressor_rpm": "rpm",
    "outdoor_coil_temp_f": "degF", "static_pressure": "inwc", "idu_cfm": "cfm", "idu_iducfm": "cfm", "odu_iducfm": "cfm", "op_status": "enum", "odu_mode": "enum",
    "idu_status": "enum", "kwh_day": "kWh", "cost_day_usd": "USD", "kwh_interval": "kWh", "ccf_interval": "ccf",
}
# Sources, and metrics of day grain.
SOURCES = ("leviton", "bryant", "lge")
DAY_GRAIN = ("kwh_day", "cost_day_usd")
# Enum words and codes, append-only.
ENUMS = {
    "mode": {"off": 0, "heat": 1, "cool": 2, "auto": 3, "fanonly": 4, "hpheat": 5, "electric": 6, "gasheat": 7, "dehumidify": 8},
    "stage": {"off": 0, "low": 1, "high": 2, "idle": 3, "dehumidify": 4},
    "fan": {"off": 0, "low": 1, "med": 2, "high": 3},
    "idu_status": {"off": 0, "on": 1, "low": 2, "high": 3, "idle": 4},
}
# Findings in report order, instruments first.
RULES = ("corrupt_reading", "negative_reading", "frozen_channel", "feed_below_children", "meter_disagreement", "above_band", "circuit_went_quiet", "stuck_load", "strip_heat_in_mild_weather", "barn_envelope", "phantom_load_growth")
