"""Fixed values.

These must equal the behaviour being reproduced for results to match, so
they are stated plainly and together here. Everything else in the package
is parameterised on them.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour exactly)
# ---------------------------------------------------------------------------

# Page scan: front matter skipped, chapter-number line, title case ratio.
FRONT_MATTER_PAGES = 10
MIN_CHAPTER_NUMBER = 1
MAX_CHAPTER_NUMBER = 19
TITLE_UPPER_RATIO = 0.25
PAGE_LINES_SCANNED = 10
PAGE_JOIN_SEPARATOR = "\n\n"

# Boundary chunker (translation): window and strict cut thresholds.
TRANSLATE_CHUNK_SIZE = 3000
PARAGRAPH_CUT_RATIO = 0.6
SENTENCE_CUT_RATIO = 0.5
SPACE_CUT_RATIO = 0.7
SENTENCE_MARKS = [". ", "! ", "? ", ".\n"]

# Older fixed chunker: paragraph cut only, at 70 %.
FIXED_CHUNK_SIZE = 3000
FIXED_PARAGRAPH_CUT_RATIO = 0.7

# Paragraph packer (speech): size limit, joiner cost, sentence delimiters in
# priority order (only the first one present is used).
SPEECH_CHUNK_SIZE = 4000
PARAGRAPH_JOIN_COST = 2
SENTENCE_DELIMITERS = ["。", "！", "？", ".", "!", "?"]

# Line classifier (Markdown formatting of translated chapters).
TITLE_LINE_PATTERN = r"^\d+\.\s+.+"
NUMBER_LINE_PATTERN = r"^\d+$"
EARLY_HEADING_MAX_LINE = 5          # i < 5
EARLY_HEADING_MAX_LEN = 30          # len < 30
EARLY_HEADING_BAD_ENDINGS = ["。", "！", "？", "，", "；"]
TAGLINE_MAX_LINE = 10               # i < 10
TAGLINE_MAX_LEN = 50                # len < 50
TAGLINE_ENDINGS = ["。", "！", "？"]
TAGLINE_CONTAINS = "，"
SECTION_MIN_LINE = 10               # i > 10
SECTION_MAX_LEN = 20                # len < 20
SECTION_BAD_ENDINGS = ["。", "！", "？", "，", "；", "：", "、"]

# Regex segmentation of a whole document: patterns tried in order, matched
# case-insensitively and multi-line; first with more than 3 kept matches wins.
SEGMENT_PATTERNS = [
    r"\n\s*(Chapter\s+\d+[:\s]+[A-Z].{10,100})\n",
    r"\n\s*(CHAPTER\s+\d+[:\s]+[A-Z].{10,100})\n",
    r"\n\s*(\d+\n[A-Z][A-Z\s]{10,100})\n",
    r"\n\s*(PART\s+\d+\n.{10,100})\n",
    r"\n\s*(\d+[:\.]?\s+[A-Z][A-Z\s\']{15,100})\n",
]
SEGMENT_MIN_MATCHES = 4             # "> 3"
SEGMENT_TITLE_MIN_LEN = 21          # "> 20"
SEGMENT_TITLE_BANNED = ["http", "www"]
SEGMENT_TITLE_BANNED_PREFIX = "Zone "
SEGMENT_MIN_BODY = 500

# Model step: attempts, backoff base, pause after each call, failure text.
MAX_ATTEMPTS = 3
PAUSE_AFTER_CALL_S = 1
FAILED_CHUNK_TEXT = "[Translation failed for chunk %d]"
SUMMARY_INPUT_CHARS = 3000
SPEECH_INPUT_CHARS = 4000
EXPORT_PREVIEW_CHARS = 500
ELLIPSIS = "..."

# Rate limits.
SPEECH_QPM = 5
RATE_WINDOW_S = 60

# Audio size estimate.
AUDIO_KBPS = 192

# Catalogue / pages.
CJK_FIRST = "一"
CJK_LAST = "鿿"
PREVIEW_CHARS = 200
NO_SUMMARY_TEXT = "暂无摘要"
DEFAULT_TITLE_CATALOGUE = "Chapter %d"
DEFAULT_TITLE_SCAN = "Unknown"
WORDCOUNT_MISSING = "N/A"
STATUS_COMPLETED = "完成"
# ---------------------------------------------------------------------------

# Python's str.isspace() set (equals what str.strip() removes), built by rule.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3100)) if ch.isspace())
# The same set as a regex class usable by Java regex and RE2.
WS_CLASS = r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\p{Z}]"
