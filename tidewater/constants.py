"""Values that must equal the delivery tools' behaviour for results to match."""

# Fixed values (settings and formats of the delivery tools), in one place:
MV_PREFIX = "__mv_"                  # multi-value encoding fields are named with this prefix
RAW_KEY = "_raw"                     # key holding the original event text
MAX_BUFFER_BYTES = 5 * 1024 * 1024   # a staging buffer rotates once it is bigger than 5 MiB
MAX_BATCH_ROWS = 1000                # batch-size setting of the forwarder
RESULT_PAGE_CAP = 1_000_000          # rows per search result page
QUIET_SECONDS = 10                   # a small buffer is complete when unchanged this long
RETRY_TIMES = 5                      # a failing delivery is tried this often
POLL_SECONDS = 0.5                   # a running search is asked for its progress this often
RETENTION_DAYS = 1                   # loaded buffers are deleted after one day
INTAKE_WAIT = "5 seconds"            # the forwarder closes an intake batch after this wait
LOAD_CYCLE = "60 seconds"            # the forwarder loads staged buffers on this cycle
BATCH_NAME_FORMAT = "yyyyMMdd-HHmmss"  # buffers are named after the second they are opened
# Python's str.strip()/str.isspace() whitespace as a regex class (Java and RE2 syntax):
# tab, LF, VT, FF, CR; U+001C-U+001F; U+0085; and the Unicode separators \p{Z}
# (space, no-break space, ogham space, en quad .. hair space, line and paragraph
# separator, narrow no-break space, medium mathematical space, ideographic space).
PY_SPACE_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
