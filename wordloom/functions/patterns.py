"""Regular expressions and word lists.

Fixed values: these must equal the reference's for equal results, and are
stated here as text, in their natural order.
"""

# ---- fixed values: patterns as written in the reference (Python syntax) ----
VOWEL_CLUSTER = r"(?i)\b\w*([aeiou])(\1{2,}|\1(?!\1)[aeiou])\w*\b"   # R1
ELONGATED = r"(?i)\b\w*([aeiou])(\1{2,})\w*\b"                       # R2
VOWEL_RUN = r"(?i)([aeiou])\1{2,}"                                    # R3
RULE_TOKEN = r"""[a-zA-Z]+(?:\.[a-zA-Z]+)*|\d+|[.!?,:;()"'](?=\s)"""  # R4
WORD_TOKEN = r"\b\w+\b"                                              # R5
DEFAULT_TOKEN = r"(?u)\b\w\w+\b"                                     # R6

# ---- fixed values: English stop words of the reference's word list ----
ENGLISH_STOPWORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd "
    "your yours yourself yourselves he him his himself she she's her hers "
    "herself it it's its itself they them their theirs themselves what which "
    "who whom this that that'll these those am is are was were be been being "
    "have has had having do does did doing a an the and but if or because as "
    "until while of at by for with about against between into through during "
    "before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t "
    "can will just don don't should should've now d ll m o re ve y ain aren "
    "aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't "
    "haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't "
    "shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn "
    "wouldn't"
).split()

# Java-regex spellings used on Spark.  Python's str ``\w`` is exactly the
# letters, numbers and underscore, so it is written as an explicit class;
# Java's ASCII ``\w`` / ``\b`` would silently drop accented words.
WORD_CHAR = r"[\p{L}\p{N}_]"
# A word without a match is given up at its first character, not tried again
# from each of its characters (a match inside it would also be one from there).
WORD_START = rf"(?<!{WORD_CHAR})"
VOWELS = "aeiou"


def elongated(min_run: int = 3) -> str:
    """R2 generalised: a word holding one vowel repeated ``min_run`` times."""
    if min_run < 2:
        raise ValueError("min_run must be at least 2")
    return rf"(?i){WORD_START}{WORD_CHAR}*([aeiou])\1{{{min_run - 1},}}{WORD_CHAR}*"


def vowel_cluster() -> str:
    """R1: three equal vowels, or exactly two followed by another vowel."""
    return rf"(?i){WORD_START}{WORD_CHAR}*([aeiou])(\1{{2,}}|\1(?!\1)[aeiou]){WORD_CHAR}*"


def vowel_run(min_run: int = 3) -> str:
    """R3 generalised: one run of an equal vowel, case ignored."""
    if min_run < 2:
        raise ValueError("min_run must be at least 2")
    return rf"(?i)([aeiou])\1{{{min_run - 1},}}"


def rule_token() -> str:
    """R4 with Unicode digits, as Python's ``\\d`` matches them."""
    return r"""[a-zA-Z]+(?:\.[a-zA-Z]+)*|\p{Nd}+|[.!?,:;()"'](?=\s)"""


def word_token(min_len: int = 1) -> str:
    """R5 (``min_len=1``) and R6 (``min_len=2``) as Unicode word runs."""
    return WORD_CHAR + ("+" if min_len == 1 else f"{{{min_len},}}")


# ---- RE2 (DuckDB) spellings used by the oracle SQL: no back-references ----
def re2_elongated(min_run: int = 3) -> str:
    runs = "|".join(v * (min_run - 1) + v + "+" for v in VOWELS)
    return rf"(?i){WORD_CHAR}*({runs}){WORD_CHAR}*"


def re2_vowel_cluster() -> str:
    alts = []
    for v in VOWELS:
        alts.append(v * 3)
        alts.append(v * 2 + "[" + VOWELS.replace(v, "") + "]")
    return rf"(?i){WORD_CHAR}*({'|'.join(alts)}){WORD_CHAR}*"


def re2_vowel_run(min_run: int = 3) -> str:
    return "(?i)(" + "|".join(v * (min_run - 1) + v + "+" for v in VOWELS) + ")"
