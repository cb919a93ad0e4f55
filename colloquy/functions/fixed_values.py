"""Fixed values.

These must equal the values of the corpus tool this library re-implements,
or results differ. They are stated plainly and in their original order.
"""

# --- fixed values: masking patterns (user, subreddit, URL, multi-line) ---
URL_PATTERN = r"(\(|\[)?(https?|ftp|file)://[-A-Za-z0-9+&@#/%?=~_|!:,.;]+[-A-Za-z0-9+&@#/%=~_|](\)|\])?"
SUBREDDIT_PATTERN = r"(\(|\[)?r/[A-Za-z]*(\)|\])?"
USER_PATTERN = r"(\(|\[)?u/[A-Za-z]*(\)|\])?"
WHITELIST_PATTERN = "[^\u4e00-\u9fa5a-zA-Z\\p{Nd},\\,.，。!！*%￥$？?]+"
USER_MASK = "[USER]"
SUBREDDIT_MASK = "[SUB]"

# --- fixed values: characters deleted from a comment before language id ---
# The parentheses inside the class are literal, so "(" and ")" are deleted too.
EMOJI_PATTERN = "[(\U0001F000-\U0001F093)(\U0001F300-\U0001F64F)(\U0001F680-\U0001F6FF)(\u2600-\u2B55)(\U0001F57A-\U0001F991)\U0000FE0F]"

# --- fixed values: languages ---
LANGS = ['zh', 'ru', 'ja', 'hu', 'de', 'ro', 'fr', 'ko', 'es', 'it', 'nl', 'ar', 'tr', 'hi', 'cs', 'lt', 'vi', 'fi']
LANGS_WITH_EN = ['en', 'zh', 'ru', 'ja', 'hu', 'de', 'ro', 'fr', 'ko', 'es', 'it', 'nl', 'ar', 'tr', 'hi', 'cs', 'lt', 'vi', 'fi']
ZH_VARIANTS = ['zh-cn', 'zh-tw']

# --- fixed values: zip and clean thresholds ---
MIN_BODY_CHARS = 5
MAX_BODY_CHARS = 1000
MIN_LANG_PROB = 0.8
MIN_TOKENS_EXCLUSIVE = 4
MAX_TOKENS_EXCLUSIVE = 80
REPLY_PREFIX = "t1"

# --- fixed values: batch sizes ---
TRANSLATE_BATCH = 25
TRANSLATE_ROWS = 15000
ENCODE_BATCH = 1000

# --- fixed values: splits ---
SEED = 66
TAIL_TEST_ROWS = 1000
TAIL_RATIO = 1.1
RATIO_BORDERS = (0.85, 0.93)
SPLIT_CAPS = (10000, 1000, 1000)
PERCENT_SPLIT = [85, 93]
SPLIT_NAMES = ("train", "eval", "test")
SMALL_DEFAULT = 10000
SMALL_TRAIN = 1000
SMALL_TRUE = 200
EXAMPLE_ROWS = 10

# --- fixed values: encoding ---
MAX_INPUT_LENGTH = 50
MAX_TARGET_LENGTH = 50
LABEL_IGNORE = -100
PAD_ID = 0
EOS_ID = 1
UNK_ID = 2
PAD_TOKEN = "<pad>"
EOS_TOKEN = "</s>"
UNK_TOKEN = "<unk>"
SUBWORD_MARK = "▁"

# --- fixed values: metrics ---
DISTINCT_ORDERS = (1, 2, 4)
BLEU_MAX_ORDER = 4
METRIC_NAMES = ['all', 'bleu', 'sacrebleu', 'bertscore', 'sentence_distinct', 'corpus_distinct', 'entropy']
STRATEGIES = {
    'greedy': {},
    'beam_search': {'num_beams': 5, 'no_repeat_ngram_size': 2, 'num_return_sequences': 1},
    'sample': {'temperature': 0.8, 'top_k': 100, 'top_p': 0.7, 'num_return_sequences': 1},
}

# --- fixed values: 13a tokenisation of sacreBLEU (public library) ---
TOK13A_REPLACE = [("<skipped>", ""), ("-\n", ""), ("\n", " ")]
TOK13A_UNESCAPE = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
TOK13A_RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
    (r"([^0-9])([\.,])", r"\1 \2 "),
    (r"([\.,])([^0-9])", r" \1 \2"),
    (r"([0-9])(-)", r"\1 \2 "),
]

# White space as the original's language splits and strips it, shared by the Spark and SQL forms.
WS_CLASS = (r"[ \t\n\x0B\f\r\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
            r"\x{202F}\x{205F}\x{3000}]+")


def emoji_class() -> str:
    """The emoji class as a regex usable by Java and RE2 alike."""
    return EMOJI_PATTERN
