"""Fixed values.

These decide what the results are, so they are written out here once and in
their natural order. Every operator takes them as parameter defaults.
"""

# Marks that are not counted as words, in text counting.
MARKS = [":", ",", "，", "。", "《", "》", "？", "！", " ", "；"]

# Request and response markers of an API log line.
CALL_MARKERS = ["@P", "@R"]

# A paired call counts when 0 < cost <= MAX_COST_MS.
MAX_COST_MS = 1_000_000

# The two accepted log time formats, both in UTC.
LOG_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
LOG_TIME_FORMAT_NO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Sentence search.
SENTENCE_STOP = "。"
SEARCH_KEYWORD = "月"
SENTENCE_SEPARATOR = "---|---"

# Behaviour messages `userId,behaviour,type[,type...]`.
KEPT_BEHAVIOR = "VIDEO_DY"

# Access-log layout (space separated) and its sliding window.
ACCESS_MIN_FIELDS = 8
ACCESS_IP_FIELD = 0
ACCESS_PATH_FIELD = 7
ACCESS_TIME_FIELD = 3
ACCESS_PATH_PREFIX = "/"
WINDOW_LENGTH_MINUTES = 10
WINDOW_SLIDE_MINUTES = 1

# Micro-batch intervals and the Kafka rate cap per partition.
KAFKA_INTERVAL = "2 seconds"
DIRECTORY_INTERVAL = "3 seconds"
ACCESS_LOG_INTERVAL = "5 seconds"
BEHAVIOR_INTERVAL = "30 seconds"
KAFKA_RECORDS_PER_SECOND = 2000
