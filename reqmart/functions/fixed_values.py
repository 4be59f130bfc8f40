"""Fixed values. These must stay as they are for the reports to come out right."""

# Key columns of a request in the fact and request tables, and in the ledger.
REQUEST_KEYS = ["parent_request_id", "request_id", "task_id"]
REPORT_KEYS = ["parent_request_id", "req_gid", "task_id"]
LEDGER_KEYS = ["uw_req_id", "req_gid", "cpt_id"]
SCENARIO_KEYS = ["data_request_id", "scenario_id", "business_type_id"]

# Request log.
COMPLETE = "COMPLETE"
FAILED = "Failed"
TASK_PATTERN = "UW%"
UNKNOWN_LOAD_TIME = "9999-12-31 00:00:00"
CLOCK_TEXT_FROM = "2023-01-14 00:00:00"
UNKNOWN_SECONDS = 9000

# Local time of the reports.
LOCAL_ZONE = "America/Chicago"
DRUG_MIX_SINCE = "2023-01-01"

# Days of supply that part the primary from the secondary network.
TIER_DAYS = 45

# Limited-distribution drugs: flags, options, and the flags each option leaves out.
ACCESS_NONE = "N"
ACCESS_WITH = "LDD_WACCESS"
ACCESS_WITHOUT = "LDD_WOACCESS"
ACCESS_EXCLUDED_BY_OPTION = {
    "LDD w/ Access Only": [ACCESS_WITH],
    "LDD w/o Access Only": [ACCESS_WITHOUT],
    "Broad (w/ Access + w/o Access)": [ACCESS_WITH, ACCESS_WITHOUT],
}
ACCESS_ALL_INCLUDED = "All_Included"

# Calendar.
CALENDAR_FIRST = "2000-01-01"
CALENDAR_LAST = "2099-12-31"

# Days of supply that part 30-day from 90-day retail claims.
RETAIL_90_FROM = 84
RETAIL_30_BELOW = 34

# Drug class codes and pharmacy numbers that make a claim a specialty claim.
SPECIALTY_DRUG_CODES = [
    "50250065007220", "50250065007240", "50250065050310", "50250065050320", "50250065050340",
    "50250065052024", "50250065052030", "50250065052070", "50250065152040", "50250065202001",
    "50250065202003", "50250065202005", "50250065202006", "83101020102012", "83101020102013",
    "83101020102014", "83101020102015", "83101020102016", "83101020102018", "83101020102020",
    "83101020102050", "96706812032900",
]
SPECIALTY_PHARMACIES = [
    "0360963", "0591796", "0722581", "1075224", "1153852", "1158422", "1203417", "1466033",
    "1480019", "1492975", "1715830", "2132924", "2228535", "2353542", "2374584", "2429113",
    "2590215", "3137141", "3195268", "3195333", "3431397", "3958898", "3994844", "4026325",
    "4429216", "4439875", "5131228", "5922085", "1009287",
]

# Scenario payload: projected years in output order.
PROJECTED_YEARS = [1, 2, 3, 0]

# Market share: claim categories that count, and the retail channel of the bucket table.
SHARE_CATEGORIES = ["SPECIALTY", "SRX AT RETAIL"]
RETAIL_CHANNEL = "SRx at retail"
