"""Fixed values.

These must equal the values of the original programs for identical results:
the access-log line pattern (nine groups: host, remote identity, local identity,
request time, method, endpoint, protocol, status, size), the request-time
layout, the empty-input message, and the text of the application messages.
"""

# --- fixed values (keep exactly as written) ---------------------------------
ACCESS_LOG_PATTERN = r'^(\S+) (\S+) (\S+) \[([\w:/]+\s[+\-]\d{4})\] "(\S+) (\S+)\s*(\S*)" (\d{3}) (\S+)'
ACCESS_LOG_TIME_LAYOUT = "dd/MMM/yyyy:HH:mm:ss"
EMPTY_INPUT_MESSAGE = "No Data found in RDD"
APP_EVENT_MESSAGE = "Application {kind} event captured : time - {time_ms}"
APP_START_EVENT = "SparkListenerApplicationStart"
APP_END_EVENT = "SparkListenerApplicationEnd"
WORD_SEPARATOR = " "
# -----------------------------------------------------------------------------

# The pattern has no end anchor, but the original tests it with a whole-line
# match. `\z` (not `$`) also refuses a line that ends in U+0085/U+2028/U+2029,
# which `$` would let through.
ACCESS_LOG_LINE_REGEX = ACCESS_LOG_PATTERN + r"\z"

# The same lines and groups in time linear in the line. In the pattern above
# `(\S+)\s*(\S*)"` may cut one long token anywhere; here either a blank stands
# between endpoint and protocol (groups 6 and 7) or the token is the endpoint
# alone (group 8). Status and size are groups 9 and 10.
ACCESS_LOG_FAST_REGEX = ACCESS_LOG_LINE_REGEX.replace(
    r'(\S+)\s*(\S*)"', r'(?:(\S++)\s++(\S*)|(\S+))"'
)

# Reasons a line is not a parsed record.
NO_MATCH = "no_match"
BAD_TIME = "bad_time"
BAD_SIZE = "bad_size"
