"""Derived inputs with fixed rules, so that Spark and the oracle build the
same rows (see FIXTURES.md).  Small literal tables here are parameters of a
query (a dictionary, a rule list); every query still reads the driver tables.
"""

# ---- fixed values: a 20-row lemma dictionary (word, class, lemma) ----
LEMMAS = [
    ("the", "n", "the"), ("was", "v", "be"), ("were", "v", "be"), ("is", "v", "be"),
    ("are", "v", "be"), ("has", "v", "have"), ("had", "v", "have"), ("does", "v", "do"),
    ("did", "v", "do"), ("words", "n", "word"), ("years", "n", "year"),
    ("children", "n", "child"), ("men", "n", "man"), ("women", "n", "woman"),
    ("better", "a", "good"), ("best", "a", "good"), ("running", "v", "run"),
    ("ran", "v", "run"), ("les", "n", "le"), ("des", "n", "de"),
]

# ---- fixed values: author-group rules on the source name ----
SOURCE_RULES = [(r"^src1[0-9]$", "teen"), (r"^src[02468]$", "even")]


def lemma_sql_values() -> str:
    rows = ", ".join(f"('{w}', '{c}', '{l}')" for w, c, l in LEMMAS)
    return f"(VALUES {rows}) AS lem(word, cat, lemma)"


def stopword_sql_list() -> str:
    from ..functions.patterns import ENGLISH_STOPWORDS
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOPWORDS)


def lemma_df(spark):
    return spark.createDataFrame(LEMMAS, "word string, cat string, lemma string")
