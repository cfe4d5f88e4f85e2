"""Fixed values and small dimensions. Every table here is a constant of a few
rows, so embedding it in an expression or broadcasting it has a known bound."""

from __future__ import annotations

# --- fixed values: priorities -------------------------------------------------
CLASSIFICATION_PRIORITY = {
    "Primary": 1,
    "Secondary": 2,
    "Support": 3,
    "Low Relevance": 4,
    "Non-Business": 5,
    "Unknown": 6,
}
OTHER_CLASSIFICATION = 99

TYPE_PRIORITY = {
    "Main Line": 1,
    "Mainline": 1,
    "Headquarters": 2,
    "Zentrale": 2,
    "Reception": 3,
    "Sales": 10,
    "Sales Department": 10,
    "Customer Service": 11,
    "Support": 12,
    "Support Hotline": 12,
    "Technical Support": 13,
    "Info-Hotline": 15,
    "RA-MICRO Online": 20,
    "Vertragsmanagement": 21,
    "Direct Dial": 25,
    "Mobile": 30,
    "Fax": 80,
    "Unknown": 99,
}
OTHER_TYPE = 90

REPORT_CLASS_ORDER = ["Primary", "Secondary", "Support", "Low Relevance", "Non-Business"]
EXCLUDED_CONTACT_TYPES = ["Unknown", "Fax", "Mobile", "Date", "ID"]

# --- fixed values: fault categories of row outcomes ----------------------------
FAULTS = {
    "Input_URL_Invalid": "Input Data Issue",
    "Input_URL_UnsupportedScheme": "Input Data Issue",
    "Scraping_AllAttemptsFailed_Network": "Website Issue",
    "Scraping_AllAttemptsFailed_AccessDenied": "Website Issue",
    "Scraping_ContentNotFound_AllAttempts": "Website Issue",
    "Scraping_Success_NoRelevantContentPagesFound": "Website Issue",
    "Canonical_Duplicate_SkippedProcessing": "Pipeline Logic/Configuration",
    "Canonical_NoRegexCandidatesFound": "Pipeline Logic/Configuration",
    "LLM_NoInput_NoRegexCandidates": "Pipeline Logic/Configuration",
    "LLM_Output_NoNumbersFound_AllAttempts": "LLM Issue",
    "LLM_Output_NumbersFound_NoneRelevant_AllAttempts": "LLM Issue",
    "LLM_Processing_Error_AllAttempts": "LLM Issue",
    "DataConsolidation_Error_ForRow": "Pipeline Error",
    "Pipeline_Skipped_MaxRedirects_ForInputURL": "Website Issue",
    "Pipeline_Skipped_PreviouslyFailedInput": "Pipeline Logic/Configuration",
    "Unknown_Processing_Gap_NoContact": "Unknown",
}

# --- fixed values: fetch status codes ------------------------------------------
FETCH_STATUS = {
    -1: "TimeoutError",
    -2: "DNSError",
    -3: "ConnectionRefused",
    -4: "PlaywrightError",
    -5: "GenericScrapeError",
    -6: "RequestAborted",
}

# --- fixed values: keyword lists ------------------------------------------------
TARGET_LINK_KEYWORDS = [
    "contact", "about", "support", "impressum", "kontakt", "legal", "privacy",
    "terms", "hilfe", "datenschutz", "ueber-uns",
]
CRITICAL_KEYWORDS = ["impressum", "kontakt", "contact", "imprint"]
HIGH_KEYWORDS = ["legal", "privacy", "terms", "datenschutz", "ueber-uns", "about", "about-us"]
EXCLUDED_PATH_PATTERNS = ["/media/", "/blog/", "/wp-content/", "/video/", "/hilfe-video/"]
PAGE_TYPE_KEYWORDS = {
    "contact": ["contact", "kontakt", "ansprechpartner"],
    "imprint": ["imprint", "impressum", "legal-notice", "legalnotice"],
    "legal": ["privacy", "datenschutz", "terms", "agb", "legal"],
}
INDEX_FILES = [
    "index.html", "index.htm", "index.php", "default.html", "default.htm",
    "index.asp", "default.asp",
]
PROBE_TLDS = ["de", "com", "at", "ch"]
LABEL_TLDS = ["com", "de", "org", "net", "uk", "io", "co", "eu", "info", "biz", "at", "ch"]
LABEL_TLD_HINTS = [
    ".com", ".de", ".org", ".net", ".io", ".co", ".eu", ".info", ".biz", ".at", ".ch",
]
# Two-label public suffixes; every other host ends in a one-label suffix.
TWO_LABEL_SUFFIXES = [
    "co.uk", "org.uk", "ac.uk", "gov.uk", "co.at", "or.at", "ac.at", "gv.at",
    "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br",
    "co.za", "com.tr", "com.pl", "co.in",
]

# --- fixed values: input profiles -------------------------------------------------
INPUT_PROFILES = {
    "default": {
        "Unternehmen": "CompanyName",
        "Webseite": "GivenURL",
        "Telefonnummer": "GivenPhoneNumber",
        "Beschreibung": "Description",
    },
    "alternate": {
        "firma": "CompanyName",
        "url": "GivenURL",
        "Telefonnummer": "GivenPhoneNumber",
    },
}
DEFAULT_TARGET_COUNTRIES = ["DE", "AT", "CH"]

# --- numbering plan (public national plans, structural) ----------------------------
# region, dial code, international prefix, trunk prefix, pattern of the national number
DIAL_PLAN = [
    ("DE", "49", "00", "0", "[1-9][0-9]{5,12}"),
    ("AT", "43", "00", "0", "[1-9][0-9]{4,12}"),
    ("CH", "41", "00", "0", "[1-9][0-9]{8}"),
    ("US", "1", "011", "1", "[2-9][0-9]{2}[2-9][0-9]{6}"),
    ("GB", "44", "00", "0", "[1-9][0-9]{8,9}"),
    ("FR", "33", "00", "0", "[1-9][0-9]{8}"),
    ("NL", "31", "00", "0", "[1-9][0-9]{8}"),
    ("BE", "32", "00", "0", "[1-9][0-9]{7,8}"),
    ("LU", "352", "00", "", "[2-9][0-9]{4,10}"),
    ("LI", "423", "00", "", "[2-9][0-9]{6}"),
    ("IT", "39", "00", "", "[03][0-9]{5,10}"),
    ("ES", "34", "00", "", "[5-9][0-9]{8}"),
    ("DK", "45", "00", "", "[2-9][0-9]{7}"),
    ("SE", "46", "00", "0", "[1-9][0-9]{6,8}"),
    ("PL", "48", "00", "", "[1-9][0-9]{8}"),
    ("CZ", "420", "00", "", "[2-9][0-9]{8}"),
    ("CA", "1", "011", "1", "[2-9][0-9]{2}[2-9][0-9]{6}"),
    ("IE", "353", "00", "0", "[1-9][0-9]{6,8}"),
    ("PT", "351", "00", "", "[2-9][0-9]{8}"),
    ("NO", "47", "00", "", "[2-9][0-9]{7}"),
    ("FI", "358", "00", "0", "[1-9][0-9]{4,10}"),
    ("HU", "36", "00", "06", "[1-9][0-9]{7,8}"),
    ("GR", "30", "00", "", "[26-9][0-9]{9}"),
    ("RO", "40", "00", "0", "[2-9][0-9]{8}"),
    ("BG", "359", "00", "0", "[2-9][0-9]{6,8}"),
    ("HR", "385", "00", "0", "[1-9][0-9]{6,8}"),
    ("SI", "386", "00", "0", "[1-9][0-9]{7}"),
    ("SK", "421", "00", "0", "[2-9][0-9]{8}"),
    ("TR", "90", "00", "0", "[2-9][0-9]{9}"),
    ("RU", "7", "810", "8", "[3-9][0-9]{9}"),
    ("UA", "380", "00", "0", "[3-9][0-9]{8}"),
    ("IL", "972", "00", "0", "[2-9][0-9]{7,8}"),
    ("ZA", "27", "00", "0", "[1-8][0-9]{8}"),
    ("BR", "55", "00", "0", "[1-9][0-9]{9,10}"),
    ("MX", "52", "00", "", "[2-9][0-9]{9}"),
    ("AR", "54", "00", "0", "[1-9][0-9]{9,10}"),
    ("JP", "81", "010", "0", "[1-9][0-9]{8,9}"),
    ("CN", "86", "00", "0", "[1-9][0-9]{8,10}"),
    ("KR", "82", "00", "0", "[1-9][0-9]{7,9}"),
    ("IN", "91", "00", "0", "[1-9][0-9]{9}"),
    ("SG", "65", "000", "", "[3689][0-9]{7}"),
    ("HK", "852", "001", "", "[2-9][0-9]{7}"),
    ("AE", "971", "00", "0", "[2-9][0-9]{7,8}"),
    ("AU", "61", "0011", "0", "[1-478][0-9]{8}"),
    ("NZ", "64", "00", "0", "[2-9][0-9]{7,9}"),
]
# Country codes of the public international plan: zones with two-digit codes, then the assigned three-digit ranges.
CALLING_CODES = "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split() + [
    str(c) for first, last in (
        (211, 213), (216, 216), (218, 218), (220, 258), (260, 269), (290, 291), (297, 299), (350, 359), (370, 378),
        (380, 383), (385, 387), (389, 389), (420, 421), (423, 423), (500, 509), (590, 599), (670, 670), (672, 683),
        (685, 692), (800, 800), (808, 808), (850, 850), (852, 853), (855, 856), (880, 880), (886, 886), (960, 968),
        (970, 977), (992, 996), (998, 998)) for c in range(first, last + 1) if c != 671]
TARGET_DIAL_CODES = ["49", "41", "43"]
LABEL_REGIONS = ["DE", "CH", "AT"]
DEFAULT_REGION = "DE"
SCAN_REGION = "US"

# --- failure log -------------------------------------------------------------------
# The group that the log reports for a stage, by the stage's beginning.
FAILURE_GROUPS = [
    ("Scraping_", "Scraping"),
    ("LLM_", "LLM"),
    ("URL_Validation_", "URL Validation"),
    ("Regex_Extraction_", "Regex Extraction"),
    ("RowProcessing_", "Row Processing"),
]
PROMPT_PLACEHOLDER = "{{candidates}}"
