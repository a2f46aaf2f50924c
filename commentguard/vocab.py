"""Fixed values that must equal the monitored application's for identical results.

FIXED VALUES — kept verbatim, in their natural order. Position in
TYPE_ATTACK_LABELS is the bit index of the 19-character type bit string.
"""

from __future__ import annotations

# FIXED VALUES: attack-type label vocabulary, in bit order.
TYPE_ATTACK_LABELS = [
    "Threat", "Scam", "Misinformation", "Boycott", "Body Shaming", "Sexual Harassment",
    "Intelligence", "Moral", "Victim Blaming", "Gender", "Regionalism", "Racism",
    "Classism", "Religion", "Politics", "Social Issues", "Product", "Community", "Other",
]

# FIXED VALUES: severity code -> name; any other code is UNKNOWN_LEVEL.
LEVEL_NAMES = {0: "Normal", 1: "Clean", 2: "Offensive", 3: "Hate"}
UNKNOWN_LEVEL = "Unknown"

# FIXED VALUES: the three severity targets, in score order.
TARGETS = ["Individual", "Group", "Societal"]

# FIXED VALUES: default Vietnamese stopwords of the online cleaner (74 words).
DEFAULT_STOPWORDS = [
    "bị", "bởi", "cả", "các", "cái", "cần", "càng", "chỉ", "chiếc", "cho", "chứ", "chưa", "chuyện",
    "có", "có_thể", "cứ", "của", "cùng", "cũng", "đã", "đang", "đây", "để", "đến_nỗi", "đều", "điều",
    "do", "đó", "được", "dưới", "gì", "khi", "là", "lại", "lên", "lúc", "mà", "mỗi", "một_cách",
    "này", "nên", "nếu", "ngay", "nhiều", "như", "nhưng", "những", "nơi", "nữa", "phải", "qua", "ra",
    "rằng", "rất", "rồi", "sau", "sẽ", "so", "sự", "tại", "theo", "thì", "trên", "trước", "từ", "từng",
    "và", "vẫn", "vào", "vậy", "vì", "việc", "với", "vừa",
]

# FIXED VALUES: UI phrases that are not comments on collected pages.
UI_PHRASES = ["Viết bình luận...", "Đang tải...", "Phù hợp nhất", "Tất cả bình luận"]

# FIXED VALUES: scoring and monitoring parameters.
TYPE_THRESHOLD = 0.3          # stage-2 sigmoid threshold (serving uses strict >)
TOXIC_LEVEL = 2               # is_hate when any severity >= this
GATE_LEVEL = 3                # stage 2 runs when any severity == this
SERVE_MAX_TOKENS = 60         # serving truncation
TRAIN_MAX_TOKENS = 128        # training truncation
TREND_BLOCK = "5 seconds"     # trend bucket
ALERT_WINDOW_SECONDS = 3      # trailing alert window
ALERT_BASELINE = 2.0          # toxic/s considered normal
ALERT_THRESHOLD = 5.0         # toxic/s that raises the alert
DISPLAY_SHIFT_HOURS = 7       # dashboard display shift
RECENT_ROWS = 50              # live-log table size
SWEEP_FROM, SWEEP_TO = 15, 59  # threshold sweep in hundredths, inclusive
SPLIT_SEED = 42


# FIXED VALUES: the cleaning patterns. URLs, mentions, e-mails and any
# non-word non-space character are noise; the author line is everything up to
# the first newline. SPACE_CLASS is Python's str.isspace() set and \p{L}\p{N}_
# its Unicode \w, spelled so that Java regex and RE2 read them alike.
AUTHOR_LINE_PATTERN = r"^[^\n]*\n"
SPACE_CLASS = r"\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}"
NOISE_PATTERN = (
    rf"(https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+)|(@[\p{{L}}\p{{N}}_]+)"
    rf"|([^{SPACE_CLASS}]+@[^{SPACE_CLASS}]+)|([^\p{{L}}\p{{N}}_{SPACE_CLASS}])"
)
# The same pattern without the two alternatives that need an "@"; it gives the same
# result on any text without "@" and avoids scanning every word for one.
NOISE_PATTERN_NO_AT = rf"(https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+)|([^\p{{L}}\p{{N}}_{SPACE_CLASS}])"
WHITESPACE_RUN = rf"[{SPACE_CLASS}]+"
EDGE_WHITESPACE = rf"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$"
