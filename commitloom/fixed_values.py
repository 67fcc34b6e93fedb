"""Fixed values.

Every result depends on these matching exactly: patterns, word lists, labels,
markers, limits and ranges.  They are kept together, as plain text, in natural
order.
"""

# --- fixed values: limits ---------------------------------------------------
MAX_COMMITS = 1000
MAX_COMMITS_CEILING = 2147483642
HISTORY_DEPTH = 5
MAX_DIFF_SIZE = 50000
MAX_STYLE_SIZE = 10000
MIN_TARGET_LENGTH = 3
MIN_STARS = 100
REPOS_PER_PAGE = 100
MAX_TOKENS = 2048
IGNORED_LABEL = -100

# --- fixed values: markers and placeholders ---------------------------------
TRUNCATION_MARKER = "...TRUNCATED"
NONE_PLACEHOLDER = "(none)"
STYLE_PLACEHOLDER = "(not specified)"
LICENSE_UNKNOWN = "Unknown"
LICENSE_NONE = "No License"
LICENSE_UNREADABLE = "Detection Failed: JSONDecodeError"

# --- fixed values: style files, most wanted first ----------------------------
STYLE_PATHS = ("CONTRIBUTING.md", ".github/CONTRIBUTING.md", "STYLEGUIDE.md")

# --- fixed values: fields normalised by default ------------------------------
TEXT_FIELDS = ("commit_msg", "change", "recent_commits_message", "code_style")

# --- fixed values: subject patterns -------------------------------------------
NOISE_SUBJECT = r"^(?:[Mm]erge\s|[Rr]evert\s|squash!|fixup!)"
BOT_AUTHOR = r"\b(?:bot|robot)\b|\[bot\]"
ISSUE_PHRASE = r"\b(?:fixes|closes|resolves|related|addresses?)\s*#[0-9]+\b"
ISSUE_IN_PARENTHESES = r"\s*\(#[0-9]+\)"
ISSUE_GLUED = r"\b#[0-9]+\b"
SUBJECT_PUNCTUATION = ".,;:!?"

# --- fixed values: code points that count as surrounding whitespace ------------
WHITESPACE_CODE_POINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009,
    0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# --- fixed values: code point ranges kept by the character filter --------------
KEPT_RANGES = (
    (0x0009, 0x0009),
    (0x000A, 0x000A),
    (0x0020, 0x007E),
    (0x00A0, 0x00A0),
    (0x2000, 0x200F),
    (0x2028, 0x202F),
    (0x3000, 0x303F),
    (0x4E00, 0x9FFF),
    (0x3400, 0x4DBF),
    (0xF900, 0xFAFF),
    (0x3040, 0x309F),
    (0x30A0, 0x30FF),
    (0xAC00, 0xD7AF),
    (0x0600, 0x06FF),
    (0x0400, 0x04FF),
    (0x2060, 0x206F),
)

# --- fixed values: lowest code point each normalisation form can change ---------
# (Unicode character database: everything below is stable under the form)
FIRST_UNSTABLE = {"NFC": 0x0300, "NFD": 0x00C0, "NFKC": 0x00A0, "NFKD": 0x00A0}

# --- fixed values: prompt wording -------------------------------------------------
LABEL_FILES = "Affected files: "
LABEL_DIFF = "Diff (code changes): "
LABEL_RECENT = "Recent commit examples: "
LABEL_STYLE = "Code style guidelines: "
LABEL_MESSAGE = "Commit message:"
INSTRUCTION = (
    "You are an AI assistant that writes concise, high-quality Git commit messages.\n"
    "Task: Refer to the information provided, and then write a concise, imperative commit message describing the change.\n\n"
)
