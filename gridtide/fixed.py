"""Fixed values that must equal the reference's for identical results.

Column names, rule messages, season months and daylight hours below are
domain constants of the telemetry format and the rule book; they are stated
here plainly and in their natural order.
"""

# --- fixed values: column names of a raw reading ---------------------------------
KEY = "inverter_serial_no"
TIME = "date_time"
DROPPED_AT_LOAD = "date_time_simulated"
ATTRIBUTES = ("site_name", "registration_no")
PROVENANCE = "file_id"
CAPACITY = "battery_capacity_percentage"
COUNTERS = (
    "on_grid_total_yield_kwh",
    "total_feed_in_energy_kwh",
    "total_consume_energy_from_grid_kwh",
    "pv_total_power_generation_kwh",
    "total_battery_charge_kwh",
    "total_battery_discharge_kwh",
)

DELTA_PREFIX = "Instantaneous_"
TIME_FORMAT = "dd/MM/yyyy HH:mm"

# --- fixed values: derived column names -------------------------------------------
BATTERY_BEHAVIOUR = "BatteryBehaviour"
HOUSE_POWER = "Total_power_used_in_house"
MONTH = "month"
SEASON = "Season"
TIME_OF_DAY = "TimeofDay"
VALIDATION_RESULT = "validation_result"
IS_VALID = "is_valid"
ERROR_MESSAGE = "error_message"
IS_REJECTED = "Is_Rejected"
IS_DUPLICATE = "Is_Duplicate"

# --- fixed values: calendar of the reference ---------------------------------------
CALENDAR_START = "2022-07-01 00:00:00"
CALENDAR_DAYS = 365
STEP_MINUTES = 30
MISSING_THRESHOLD = 2880

# --- fixed values: labels -----------------------------------------------------------
SOLAR_CHARGING = "Solar Charging"
GRID_CHARGING = "Grid Charging"
DISCHARGING = "Discharging"
OTHER = "Other"
UNKNOWN = "Unknown"
DAY = "Day"
NIGHT = "Night"
VALID = "Valid"

# Season -> months (inclusive), in calendar order of the rule book.
SEASON_MONTHS = (
    ("Spring", (3, 4, 5)),
    ("Summer", (6, 7, 8)),
    ("Autumn", (9, 10, 11)),
    ("Winter", (12, 1, 2)),
)
# Season -> first and last daylight hour (inclusive).
DAYLIGHT_HOURS = (
    ("Spring", 7, 19),
    ("Summer", 5, 21),
    ("Autumn", 7, 19),
    ("Winter", 8, 17),
)

# --- fixed values: row-rule messages, in evaluation order -------------------------
MSG_YIELD_NEGATIVE = "On Grid Total Cannot be Negative"
MSG_FEED_IN_NEGATIVE = "Feed in energy Cannot be Negative"
MSG_FEED_IN_LOW_BATTERY = "Feed in cannot happen if battery % is less than 10"
MSG_FEED_IN_AND_CONSUME = "Feed in and consumption can not happen same time"
MSG_CONSUME_NEGATIVE = "Consumption from grid cannot be negative"
MSG_CAPACITY_RANGE = "Battery capacity should be within the range"
MSG_CHARGE_AND_DISCHARGE = "Battery charge and discharge cannot happen at same time"
MSG_CHARGE_NEGATIVE = "Battery charge be negative"
MSG_DISCHARGE_NEGATIVE = "Battery discharge cannot be negative"
MSG_DISCHARGE_NO_USE = (
    "Battery discharge can not have any value if there is no consumption and feed in to grid"
)
MSG_PV_NEGATIVE = "PV Power generation can not be negative"
MSG_PV_AT_NIGHT = "PV value can not be at night"
MSG_GRID_NO_USE = "Cannot consume from grid, if no usage"
ERROR_SEPARATOR = ", "

# Counters and thresholds used by the rules and cleansers.
LOW_BATTERY_PERCENT = 10
CAPACITY_MIN = 0
CAPACITY_MAX = 100
IQR_MULTIPLIER = 1.5
IQR_QUANTILES = (0.25, 0.75)
OUTLIER_COLUMNS = ("total_battery_charge_kwh", "total_battery_discharge_kwh")
