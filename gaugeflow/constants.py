"""Fixed values.

Everything below must equal the values used by the original station scripts
for the results to match: column names, parameter names, page groups, link
labels, the estimated-reading tag and code, the station-id word lists, the
status texts and the date formats. They are stated here once, in natural
order, and imported everywhere else.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the original tool's)
# ---------------------------------------------------------------------------

# Column order of the long hourly table.
HOURLY_COLUMNS = [
    "STATION_NUMBER",
    "STATION_NAME",
    "Date",
    "Time",
    "Value",
    "Parameter",
    "Code",
    "Comments",
]

# Column order of the daily mart.
DAILY_COLUMNS = [
    "STATION_NUMBER",
    "STATION_NAME",
    "Date",
    "Value",
    "numObservations",
    "Parameter",
]

# Column order of the station dimension.
STATION_COLUMNS = [
    "station_id",
    "station_name",
    "station_url_name",
    "start_date",
    "end_date",
    "water_temperature",
    "staff_gauge",
    "voltage",
    "barometric_pressure",
    "lat",
    "long",
    "site_info",
]

# Page groups, in the order the update jobs walk them.
GROUP_HYDROMETRIC = "Hydrometric"
GROUP_PRESSURE = "Pressure"
GROUP_TEMPERATURE = "Temperature"
GROUPS = [GROUP_HYDROMETRIC, GROUP_PRESSURE, GROUP_TEMPERATURE]

# Positional column names of a data page, by group and page width.
# Any group other than Hydrometric and Pressure uses the temperature names.
PAGE_COLUMNS = {
    (GROUP_HYDROMETRIC, 3): ["Time", "Water Level", "Sensor Depth"],
    (GROUP_HYDROMETRIC, 2): ["Time", "Water Level"],
    (GROUP_PRESSURE, 2): ["Time", "Pressure"],
    (GROUP_TEMPERATURE, 3): ["Time", "Air Temperature", "Water Temperature"],
    (GROUP_TEMPERATURE, 2): ["Time", "Water Temperature"],
}


# Availability flag -> data page name in the station URL.
VARIABLE_PAGES = {
    "staff_gauge": "WaterLevel",
    "water_temperature": "Temperature",
    "barometric_pressure": "Pressure",
}
VARIABLES = ["staff_gauge", "water_temperature", "barometric_pressure"]
VARIABLE_ERROR = "no page group is fed by this variable"

# Availability flag that feeds each page group.
GROUP_VARIABLES = {
    GROUP_HYDROMETRIC: "staff_gauge",
    GROUP_PRESSURE: "barometric_pressure",
    GROUP_TEMPERATURE: "water_temperature",
}

# Path part in front of the station url name in every station link.
CONTENT_PATH = "Content%20Pages/"

# Tag that marks an estimated reading and the code written for it.
ESTIMATED_TAG = "**Estimated"
ESTIMATED_CODE = "21"
NO_CODE = ""
NO_COMMENT = ""

# Link status texts.
STATUS_SUCCESS = "success"
STATUS_LINK_INVALID = "Error: link invalid"
ERROR_PREFIX = "Error: "
HTTP_OK = 200

# Navigation labels kept from a station's sidebar entry.
NAV_LABELS = [
    "Water Temperature",
    "Barometric Pressure",
    "Staff Gauge",
    "Voltage",
    "Site Info",
]
# Labels of which at least one must be present for a station to be kept.
SERVED_LABELS = ["Staff Gauge", "Water Temperature", "Barometric Pressure"]
# Sidebar title that is not a station.
ADMIN_TITLE = "Admin"
# CSS class of the sidebar entry title and of the data table.
NAV_TITLE_CLASS = "sf-with-ul"
NAV_LIST_ID = "example"
DATA_TABLE_CLASS = "CenteredGrid"

# Station id rules.
STATION_ID_PREFIX = "P_"
WATER_WORDS = ["RIVER", "LAKE", "CREEK"]
UPPER_LOWER = ["UPPER", "LOWER"]

# Archive start asked for by a station reset, and its one override.
RESET_START = "01/01/2000 00:00"
RESET_START_OVERRIDES = {"Leiner": "10/09/2018 11:01"}
RESET_START_FORMAT = "%m/%d/%Y %H:%M"

# Windows (days).
LOOKBACK_DAYS = 30
RECENT_DAYS = 366

# CSV null text of the station file.
CSV_NULL = "NA"

# Missing-value texts of an HTML table cell (pandas read_html defaults).
NA_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
