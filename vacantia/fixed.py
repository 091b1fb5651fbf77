"""Names, patterns, labels and formats that outside data or stored files dictate."""

# --- fixed values: column lists of the stored tables -------------------------------------------
JOB_COLUMNS = [
    "job_id", "title", "department", "location", "date_posted",
    "time_scraped", "url", "company_intro", "role_description", "listings",
]
AGGREGATOR_COLUMNS = [
    "job_id", "title", "company", "department", "location", "date_posted",
    "time_scraped", "url", "company_intro", "role_description", "listings", "original_url",
]

# --- fixed values: company profile members ------------------------------------------------------
COMPANY_META = [
    "slug", "fullname", "industry", "sector", "website", "hqaddr", "hqcity", "hqstate", "hqzip",
    "hqtel", "ranking", "newcomer", "prevrank", "yearsonlist", "ceo", "ceoforeign", "ceofounder",
    "ceowoman", "employees", "jobgrowth", "jobgrowthnum", "linkedin", "twitter", "assets",
    "ticker", "mktval", "totshequity", "revenues", "revchange", "eps", "epschange", "eps10yr",
    "eps5yr", "profitable", "profits", "prftchange", "prftpctasts", "prftpctseqty", "prftpctsls",
    "totrti", "totrti5yr", "totrti10yr",
    "100-fastest-growing-companies-rank", "100-fastest-growing-companies-y-n",
    "best-companies-rank", "best-companies-y-n",
    "change-the-world-rank", "change-the-world-y-n",
    "global500-rank", "global500-y-n",
    "worlds-most-admired-companies-rank", "worlds-most-admired-companies-y-n",
]
COMPANY_COLUMNS = [
    "slug", "fullname", "fortune_id", "shortname", "industry", "sector", "website", "hqaddr",
    "hqcity", "hqstate", "hqzip", "hqtel", "ranking", "newcomer", "prevrank", "yearsonlist", "ceo",
    "ceoforeign", "ceofounder", "ceowoman", "employees", "jobgrowth", "jobgrowthnum", "linkedin",
    "twitter", "assets", "ticker", "mktval", "totshequity", "revenues", "revchange", "eps",
    "epschange", "eps10yr", "eps5yr", "profitable", "profits", "prftchange", "prftpctasts",
    "prftpctseqty", "prftpctsls", "totrti", "totrti5yr", "totrti10yr",
    "100-fastest-growing-companies-rank", "100-fastest-growing-companies-y-n",
    "best-companies-rank", "best-companies-y-n",
    "change-the-world-rank", "change-the-world-y-n",
    "global500-rank", "global500-y-n",
    "worlds-most-admired-companies-rank", "worlds-most-admired-companies-y-n",
    "fortune_link", "logo", "description",
]
COMPANY_ROOT = [("id", "fortune_id"), ("title", "shortname"), ("description", "description")]
COMPANY_LINKED = [("link", "fortune_link"), ("logo", "logo")]

# --- fixed values: section labels ---------------------------------------------------------------
AMAZON_SECTIONS = [
    ("basic_qualifications", "Basic Qualifications"),
    ("preferred_qualifications", "Preferred Qualifications"),
]
APPLE_SECTIONS = [
    ("additionalRequirements", "Additional Requirements"),
    ("description", "Description"),
    ("educationDetails", "Education"),
    ("keyQualifications", "Qualifications"),
    ("preferredQualifications", "Preferred Qualifications"),
]

# --- fixed values: patterns and URL parts -------------------------------------------------------
BULLET = "\u2022"
BULLET_BREAK = "<br/>\\s*\u2022"
LITERAL_BULLET_BREAK = "<br/>\\s*u2022"
COUNTRY_PREFIX = "US"
PLACE_PATTERN = ", [A-Z][A-Z]"
PLACES_PATTERN = r"^\((.+)\)$"
PLACES_SEPARATOR = " - "
FACEBOOK_LINK_ID = "/careers/jobs/([^/]+)/"
FACEBOOK_REQUEST_ID = r"^/careers/resume\?(?:.*&)?req=([^&]+)(?:&.*)?$"
DICE_RESULT_ID = r"/result/(.+)\?src"
DICE_RESULT_PREFIX = "http://www.dice.com/job/result/"
DICE_DETAIL_PREFIX = "https://www.dice.com/jobs/detail/"
APPLE_POSTING_URL = "https://jobs.apple.com/us/search#&ss="
AMAZON_JOB_PATH = "/en/jobs/"
RFC822_DATE = r"^\w+,\s(\d{1,2}\s+\w{3,3}\s+\d{2,4}),?\s+"

# --- fixed values: characters that stripping removes (every Unicode blank) ----------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u180e"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: week columns -----------------------------------------------------------------
WEEK_COLUMNS = ["A", "B", "C", "D", "E", "F"]
