"""Results depend on them, so they are stated once and never derived."""

# Fixed values of the customer flow.
ACTIVE_STATUS = "active"
SAMPLE_SOURCE_SYSTEM = "sample_system"
EMAIL_DOMAIN_PATTERN = "@(.+)"
CREATED_DATE_FORMAT = "yyyy-MM-dd"

# Fixed values of part-file selection.
PART_FILE_PREFIX = "part-"
JSON_SUFFIX = ".json"
TEXT_SUFFIX = ".txt"

# Fixed value: the characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
