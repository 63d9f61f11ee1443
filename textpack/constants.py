"""Values fixed by the data formats this package reads and writes."""

# --- fixed values: must equal the file format and the vocabulary on disk ------------------
EOS_TOKEN = "<|endoftext|>"
USER_TOKEN = "<|user|>"
ASSISTANT_TOKEN = "<|assistant|>"
END_TOKEN = "<|end|>"
CHAT_TOKENS = [USER_TOKEN, ASSISTANT_TOKEN, END_TOKEN]

INSTRUCTION_PREFIXES = ["Features:", "Words:", "Summary:"]
STORY_PREFIX = "Story:"
DEFAULT_USER_TURN = "Write a short story for me."

COMMON_WORDS = ["the", "and", "a", "to", "of", "was", "she", "he", "said", "in",
                "it", "they", "her", "his", "had", "on", "with", "mom", "day"]
MIN_ASCII_RATIO = 0.95
MIN_COMMON_WORDS = 2
MIN_DISTINCT_WORDS = 5

MAX_CHAT_TOKENS = 250
VAL_FRACTION = 0.05
SEED = 42
CONTEXT_LENGTH = 256
BASE_VOCAB_SIZE = 4096
MAX_VOCAB_SIZE = 65536
INIT_STD = 0.02

# The 29 code points that Python's str.strip() and str.split() treat as whitespace: as characters,
# as a Java class under the (?U) flag, and as ranges that other regex engines read too.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0 "
            "           "
            "    　")
WS_JAVA = r"(?U)[\s\x1c-\x1f]"
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

# The public byte-level pre-tokenizer pattern, in Java regex syntax; its seven contractions share their apostrophe.
PIECE_RE = (r"(?U)'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
            r"|\s+(?!\S)|\s+")
# ------------------------------------------------------------------------------------------

# Symbols are handled as one private code point per token id: chr(SYMBOL_BASE + id).
# UTF-8 keeps code-point order, so comparing symbol strings compares id sequences.
SYMBOL_BASE = 0x10000


def byte_alphabet() -> list[str]:
    """Printable stand-in for each byte value 0..255 (index = byte)."""
    keep = set(range(33, 127)) | set(range(161, 173)) | set(range(174, 256))
    shifted = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(shifted)) for b in range(256)]


def byte_ids() -> list[int]:
    """Token id of each byte value: 1 + rank of its stand-in; id 0 is the EOS token."""
    alphabet = byte_alphabet()
    rank = {c: i + 1 for i, c in enumerate(sorted(alphabet))}
    return [rank[c] for c in alphabet]
