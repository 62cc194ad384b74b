"""How this library's CSV files are written and read."""

CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    # Quote doubling instead of backslash escapes, and no whitespace trimming:
    # every string reads back exactly.
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
