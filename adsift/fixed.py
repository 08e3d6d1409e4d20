"""Fixed values of the original ad-log jobs, in one place.

These must equal the original jobs' values for the results to be equal; the
operators take them as parameter defaults.
"""

# Map keys and tag names of the page-view feed.
DIM_MCC, DIM_NSV, DIM_AV = "mcc", "nsv", "av"
TAG_VENDOR, TAG_ABTEST = "vendor", "abtest"
TAG_SEP = ":"
EXT_UDID, EXT_AUID = "udid", "auid"

# Device id schemes.
IFA_MARKER = "ifa:"          # udid scheme prefix stripped by the slot reach job
ID_SCHEME_MARKER = ":"       # any scheme prefix stripped by the enrichment job
ID_PREFIX_LEN = 4

# DSP feed.
DSP_IDFA, DSP_DEVICEID = "IDFA", "DEVICEID"
DSP_SYND_ID = 112
MAX_REPORT_HOUR = 17

# Landing-page feed.
FD_KEY = "fd"
FD_ABSENT = "null"           # value listed for rows without fd
FD_ABSENT_BUCKET = "null_fd"  # bucket of slot rows without fd
OTHER_BUCKET = "else"        # bucket of rows of other slots
FD_REJECTED = ("", "null", "None")   # strict rule
FORM_MARKER = "school="
FORM_EMPTY_FIELD = "=&"
LANDING_SLOT = "780dc5048214ef5f0c94f366d2554d40"

# Job parameters.
ENRICH_APP_IDS = ("1042", "1070", "252", "380", "438", "462", "542", "554", "794", "974")
ENRICH_SPONSOR_ID = 262090
CLICK_SPONSOR_ID = 286304
OWN_APP_IDS = ("252", "462")
SLOT_MIN_DEVICES = 100

# Text formats.
DAILY_AVG_LABELS = {"ht_avg": ": ht_avg:", "lt_avg": ",lt_avg:", "pt_avg": ",pt_avg:"}
DAILY_COUNT_LABELS = {"fd_count": ",fd_count:"}
GROUP_SUM_LABELS = {"ht_sum": ",ht_sum:", "lt_sum": ",lt_sum:", "pt_sum": ",pt_sum:", "fd_count": ",count:"}
GROUP_AVG_LABELS = {"ht_avg": ",ht_avg:", "lt_avg": ",lt_avg:", "pt_avg": ",pt_avg:"}
ENRICH_SEP = ";"
WORD_SEP = " "
