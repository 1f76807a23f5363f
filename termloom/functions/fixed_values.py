"""They must equal the published behaviour for results to agree.

Everything here is data (words, patterns, defaults); the logic that uses it lives elsewhere.
"""

# English stopwords. "and", "or" and "not" are deliberately absent.
STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "but", "if", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in",
    "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "only", "own",
    "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should", "now",
)

# Text patterns, in Java regex syntax ((?U) makes \S follow Unicode white space).
LINK_PATTERN = r"(?U)https?\S+"
NON_TERM_PATTERN = r"[^ \p{L}\p{N}_-]+"

# Link rules of the crawler.
LINK_CUT_PATTERN = r"[?#][\s\S]*$"
SKIPPED_HREF_PREFIXES = ("#", "mailto")
ABSOLUTE_HREF_PREFIX = "http"

# Search defaults.
DEFAULT_FLOOR = 0.2
DEFAULT_TOP = -1
DEFAULT_MAX_DEPTH = -1

# English (Porter2) stemmer, as published with the Snowball project.
STEM_VOWELS = "aeiouy"
STEM_DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
STEM_LI_ENDINGS = "cdeghkmnrt"
STEM_R1_PREFIXES = ("gener", "commun", "arsen")
STEM_EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl",
    "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
STEM_STOP_AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEM_STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize",
    "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al",
    "fulness": "ful", "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble",
    "bli": "ble", "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEM_STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "", "ative": "",
}
STEM_STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous",
    "ive", "ize", "ion",
)
