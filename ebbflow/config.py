"""Contract constants and the default routing rules.

Everything in the FIXED VALUES block must stay equal to the behaviour the
engine reproduces (column contract, routing rules, validation limits,
report thresholds); it is configuration, not logic.
"""

from __future__ import annotations

from dataclasses import dataclass

# --------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour; keep in this order)
# --------------------------------------------------------------------------

# Declared raw-event columns, all read as strings.
REQUIRED_COLUMNS = [
    "adid", "city", "country", "device_name", "device_type", "event_name", "event",
    "lifetime_session_count", "language", "os_name", "os_version", "random_user_id",
    "session_count", "time_spent", "activity_kind", "app_name", "app_version",
    "created_at", "device_manufacturer", "installed_at", "last_session_time",
    "network_name", "app_token", "publisher_parameters", "received_at", "timezone",
    "app_version_short", "last_time_spent", "last_session_length", "campaign_name",
    "creative_name", "match_type", "tracker", "tracker_name", "adgroup_name",
    "first_tracker_name", "first_tracker", "last_tracker_name", "last_tracker",
    "gps_adid", "google_app_set_id", "idfa", "idfv", "dcp_tapjoy_click_id",
    "external_campaign_id", "external_adgroup_id", "external_creative_id", "partner",
]

# Epoch columns (seconds or milliseconds).
TIMESTAMP_COLUMNS = ["created_at", "installed_at", "last_session_time", "received_at"]

# Accepted values of lower(trim(activity_kind)).
ALLOWED_ACTIVITY_KINDS = ["session", "install", "install_update", "event"]

# Epoch values at or above this are milliseconds, below it seconds.
EPOCH_MS_THRESHOLD = 1_000_000_000_000

# Keys pulled out of publisher_parameters -> output column names.
PUBLISHER_PARAM_KEYS = [
    ("adjust_event_name", "pp_event_name"),
    ("game", "pp_game"),
    ("ad_format", "pp_ad_format"),
    ("ad_placement", "pp_ad_placement"),
    ("ad_revenue", "pp_ad_revenue"),
]

# Columns dropped from every routed table.
ROUTED_EXCLUDED_COLUMNS = ["prefix", "pp_game", "pp_ad_format", "pp_ad_placement", "pp_ad_revenue"]

# Tenant ("prefix") is the last path segment text before _YYYY-MM-DDT.
TENANT_PATTERN = r"([^/]+)_[0-9]{4}-[0-9]{2}-[0-9]{2}T"

# Source files are those whose name ends with this suffix.
SOURCE_SUFFIX = ".csv.gz"

# Ad pre-aggregate: look back this many days from the run date (inclusive).
AD_LOOKBACK_DAYS = 30
AD_EVENT_NAME = "ad_impression"
AD_AGG_TABLE_SUFFIX = "ad_impression_revenue_preaggregates"

# File governance.
RETENTION_DAYS = 7
MAX_RECORDS_PER_FILE = 1_000_000
CONTENT_WARN_CHARS = 1_000_000
STATUS_READY = "READY_FOR_PROCESSING"
STATUS_FAILED = "FAILED_VALIDATION"
REASON_INVALID_CONTENT = "INVALID_CONTENT"
REASON_EMPTY_FILE = "EMPTY_FILE"
REASON_TOO_LARGE = "FILE_TOO_LARGE"
CONTENT_ERROR_EMPTY = "File content is empty"
CONTENT_ERROR_NO_COMMA = "File does not appear to be valid CSV format (no commas found)"
CONTENT_ERROR_NO_NAME = "File name is missing"
CONTENT_WARNING_SIZE = "File size exceeds {max_size} bytes"

# Source freshness on max(load_timestamp), in hours.
FRESHNESS_WARN_HOURS = 2
FRESHNESS_ERROR_HOURS = 4

# DLQ severity by failure_count: > 10 CRITICAL, > 5 HIGH, > 1 MEDIUM, else LOW.
SEVERITY_THRESHOLDS = [(10, "CRITICAL"), (5, "HIGH"), (1, "MEDIUM")]
SEVERITY_DEFAULT = "LOW"

# Daily quality rating by success_rate: >= 99 EXCELLENT, >= 95 GOOD, >= 90 ACCEPTABLE, else POOR.
RATING_THRESHOLDS = [(99, "EXCELLENT"), (95, "GOOD"), (90, "ACCEPTABLE")]
RATING_DEFAULT = "POOR"

# Default routing rules: (table suffix, filter column, filter value, allowed tenants or None = all).
DEFAULT_RULES: list[tuple[str, str, str, list[str] | None]] = [
    ("session", "activity_kind", "session", None),
    ("install", "activity_kind", "install", None),
    ("ad_impression", "pp_event_name", "ad_impression", None),
    ("iap_purchased", "pp_event_name", "iap_purchased", None),
    ("ab_test_registered", "pp_event_name", "ab_test_registered", None),
    ("asset_balance", "pp_event_name", "Asset_Balance",
     ["ko69zatkf75s", "17ohic5adt6o", "uqgofx50smbk"]),
    ("asset_balance_lower", "pp_event_name", "asset_balance",
     ["ko69zatkf75s", "17ohic5adt6o", "uqgofx50smbk", "7kjguvz34etc",
      "j407gmj41m2o", "k38ounufgtfk", "fpfac2ufwyyo"]),
    ("earn_asset", "pp_event_name", "earn_asset",
     ["ko69zatkf75s", "17ohic5adt6o", "uqgofx50smbk", "7kjguvz34etc", "k38ounufgtfk"]),
    ("spend_asset", "pp_event_name", "spend_asset",
     ["ko69zatkf75s", "17ohic5adt6o", "uqgofx50smbk", "7kjguvz34etc", "k38ounufgtfk"]),
    ("level_started", "pp_event_name", "level_started", None),
    ("level_finished", "pp_event_name", "level_finished", None),
    ("game_started", "pp_event_name", "game_started",
     ["ezkr0rrexnnk", "uiz394n7whkw", "9nnprfr0ru9s", "frrjgz5cmn7k", "jkxyp60o5tds",
      "zshz8hwfwagw", "bpc1habv43k0", "xp43496auk8w", "237rl7lttrpc", "l5ygup2vijgg",
      "stiq7y97clc0"]),
    ("game_finished", "pp_event_name", "game_finished",
     ["ezkr0rrexnnk", "uiz394n7whkw", "9nnprfr0ru9s", "frrjgz5cmn7k", "jkxyp60o5tds",
      "zshz8hwfwagw", "bpc1habv43k0", "xp43496auk8w", "237rl7lttrpc", "l5ygup2vijgg",
      "stiq7y97clc0"]),
    ("prop_placed", "pp_event_name", "prop_placed", ["ehop1niki9ds"]),
    ("navigation_action", "pp_event_name", "navigation_action", ["vefa0uvli4g0"]),
    ("vip_level", "pp_event_name", "VIP_level", ["vefa0uvli4g0"]),
    ("unlockpopup_theme", "pp_event_name", "unlockpopup_theme", ["we2fbljzi96o"]),
    ("unlockpopup_hardmode", "pp_event_name", "unlockpopup_hardmode", ["we2fbljzi96o"]),
    ("arena_fights", "pp_event_name", "arena_fights", ["t5c1326g385c"]),
    ("hero_data", "pp_event_name", "hero_data", ["t5c1326g385c"]),
    ("power_up", "pp_event_name", "power_up", ["t5c1326g385c"]),
    ("ad_call", "pp_event_name", "ad_call",
     ["y2ybrph3py4g", "2auzkzpinhmo", "xoorjgohuku8"]),
    ("vip_bundle", "pp_event_name", "vip_bundle", ["y2ybrph3py4g"]),
    ("skin_bundle", "pp_event_name", "skin_bundle", ["y2ybrph3py4g"]),
    ("ad_failed", "pp_event_name", "ad_failed", ["o634irjqgv7k"]),
    ("menu_items", "pp_event_name", "menu_items", ["o634irjqgv7k"]),
    ("line_attempts", "pp_event_name", "line_attempts", ["2auzkzpinhmo"]),
    ("depth_reached", "pp_event_name", "depth_reached", ["eaaekboxygw0"]),
    ("ores_collected", "pp_event_name", "ores_collected", ["eaaekboxygw0"]),
    ("upgrades", "pp_event_name", "upgrades", ["eaaekboxygw0"]),
    ("achievements", "pp_event_name", "achievements", ["eaaekboxygw0"]),
    ("vehicle_used", "pp_event_name", "vehicle_used", ["ui0hcrq7ak8w"]),
    ("gun_used", "pp_event_name", "gun_used", ["ui0hcrq7ak8w"]),
    ("menu", "pp_event_name", "menu", ["ui0hcrq7ak8w"]),
    ("openworld_exploration", "pp_event_name", "openworld_exploration", ["ui0hcrq7ak8w"]),
    ("infinite_mode_started", "pp_event_name", "infinite_mode_started", ["74y98wgl3280"]),
    ("infinite_mode_finished", "pp_event_name", "infinite_mode_finished", ["74y98wgl3280"]),
    ("mode_started", "pp_event_name", "mode_started", ["efb6zp4onmyo"]),
    ("mode_finished", "pp_event_name", "mode_finished", ["efb6zp4onmyo"]),
    ("drawing_started", "pp_event_name", "drawing_started", ["uicmdljz4uf4"]),
    ("drawing_finish", "pp_event_name", "drawing_finish", ["uicmdljz4uf4"]),
    ("color_start", "pp_event_name", "color_start", ["uicmdljz4uf4"]),
    ("color_finish", "pp_event_name", "color_finish", ["uicmdljz4uf4"]),
    ("tool_started", "pp_event_name", "tool_started", ["h60r713slcsg"]),
    ("tool_finished", "pp_event_name", "tool_finished", ["h60r713slcsg"]),
    ("tutorial_completed", "pp_event_name", "tutorial_completed", ["k38ounufgtfk"]),
    ("day_completed", "pp_event_name", "day_completed", ["k38ounufgtfk"]),
]

# --------------------------------------------------------------------------
# end of FIXED VALUES
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class RunClock:
    """One timestamp per run, used wherever the reproduced behaviour reads
    ``current_timestamp`` / ``current_date``, so every layer agrees.

    ``as_of`` is a ``'YYYY-MM-DD HH:MM:SS'`` UTC string.
    """

    as_of: str

    @property
    def as_of_date(self) -> str:
        return self.as_of[:10]
