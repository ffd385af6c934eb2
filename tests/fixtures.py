"""Literal fixtures taken from reference inputs (fixed values, stated as text)."""

# ---- fixed values: the ten toy sentences of the co-occurrence exercise ----
TOY_SENTENCES = [
    "The warm sun melts the icy snow on the mountain.",
    "A warm cup of tea felt perfect in the cool morning air.",
    "Her warm smile brightened the cold winter day.",
    "I love the contrast of a warm blanket on a cold night.",
    "The cold wind chilled me, but the warm fire offered comfort.",
    "After a cold swim, the warm towel felt like heaven.",
    "The warm colors of the sunset clashed with the cold breeze.",
    "The chilly floor left her longing for the cozy comfort of slippers.",
    "A gentle breeze eased the bite of the cold ocean waves.",
    "Cold hands found solace in the warm pockets of his coat.",
]

# ---- fixed values: tokenizer sample strings ----
TOKENIZER_SAMPLES = [
    "If you have the chance, watch it. Although, a warning, you'll cry your eyes out.",
    "I don't know what to do with this course I've taken, it has all these assignments...",
    "I like this assignment because:\n-\tit is fun;\n-\tit helps me practice my Python skills.",
    "I won a prize, but I won't be able to attend the ceremony.",
    "“The strange case of Dr. Jekyll and Mr. Hyde” is a famous book... but I haven't read it.",
    "I work for the C.I.A.. And you?",
    "OMG #Twitter is sooooo coooool <3 :-) <-- lol...why do i write like this idk right? :) \U0001F937\U0001F602 \U0001F916",
]

# ---- fixed values: grammar of the parsing exercise (lhs, rhs) ----
GRAMMAR = [
    ("S", "NP VP"), ("S", "VP"), ("S", "Aux NP VP"), ("NP", "Nominal"), ("NP", "Det Nominal"),
    ("Nominal", "Noun"), ("Nominal", "Adjective Nominal1"), ("Nominal", "Nominal1 Noun"),
    ("Nominal1", "Noun"), ("Nominal1", "Adjective Nominal1"), ("VP", "Verb"), ("VP", "Verb NP"),
    ("VP", "Verb NP PP"), ("VP", "Verb PP"), ("PP", "Preposition NP"),
]

# ---- fixed values: lexicon of the parsing exercise (word, category) ----
LEXICON = [
    ("costs", "Noun"), ("fan", "Noun"), ("fans", "Noun"), ("injuries", "Noun"), ("hope", "Noun"),
    ("media", "Noun"), ("money", "Noun"), ("research", "Noun"), ("researcher", "Noun"),
    ("researchers", "Noun"), ("sports", "Noun"), ("likes", "Noun"), ("spinal", "Adjective"),
    ("social", "Adjective"), ("for", "Preposition"), ("on", "Preposition"),
    ("with", "Preposition"), ("fear", "Verb"), ("likes", "Verb"), ("need", "Verb"),
    ("needs", "Verb"), ("like", "Verb"), ("hope", "Verb"), ("fans", "Verb"), ("costs", "Verb"),
    ("a", "Det"), ("the", "Det"),
]

# ---- fixed values: the fifteen test sentences ----
SENTENCES = [
    "research fans hope for spinal injuries",
    "spinal injuries need research",
    "sports fans like research",
    "sports fans fear spinal injuries",
    "sports research costs money",
    "the fan fans the researcher with a fan",
    "researchers hope for money",
    "the fan needs sports research",
    "the researcher needs money",
    "the fan likes sports",
    "fans like likes on social media",
    "sports fans hope for likes",
    "fans need money for sports",
    "the social fan likes the researcher",
    "researchers fear the media",
]

# ---- fixed values: the normal-form grammar of the written exercise ----
CNF_GRAMMAR = [
    ("S", "NP VP"), ("VP", "V NP"), ("VP", "V VP1"), ("VP1", "NP PP"), ("NP", "Det Nominal"),
    ("NP", "Nominal PP"), ("NP", "Det NP1"), ("NP1", "Nominal PP"), ("PP", "P NP"),
]
CNF_LEXICON = [
    ("students", "NP"), ("problems", "NP"), ("AI", "NP"), ("students", "Nominal"),
    ("problems", "Nominal"), ("AI", "Nominal"), ("solve", "V"), ("like", "V"), ("hate", "V"),
    ("with", "P"), ("in", "P"), ("a", "Det"), ("the", "Det"),
]

# ---- fixed values: published score cells (model, k, dataset, score) and means ----
SCORES = [
    ("Base", 0, "ag_news", 0.33), ("Base", 0, "sst2", 0.52), ("Base", 0, "boolq", 0.56),
    ("Base", 10, "ag_news", 0.40), ("Base", 10, "sst2", 0.70), ("Base", 10, "boolq", 0.74),
    ("LoRA-CLS", 0, "ag_news", 0.72), ("LoRA-CLS", 0, "sst2", 0.66), ("LoRA-CLS", 0, "boolq", 0.40),
    ("LoRA-CLS", 10, "ag_news", 0.81), ("LoRA-CLS", 10, "sst2", 0.67), ("LoRA-CLS", 10, "boolq", 0.41),
    ("LoRA-QA", 0, "ag_news", 0.26), ("LoRA-QA", 0, "sst2", 0.51), ("LoRA-QA", 0, "boolq", 0.51),
]
SCORE_MEANS = {("Base", 0): 0.47, ("Base", 10): 0.61, ("LoRA-CLS", 0): 0.59,
               ("LoRA-CLS", 10): 0.63, ("LoRA-QA", 0): 0.43}
REASONING_BASE_K10 = [("Base", 10, "hellaswag", 0.39), ("Base", 10, "arc_easy", 0.57),
                      ("Base", 10, "piqa", 0.67), ("Base", 10, "social_iqa", 0.47)]

# ---- fixed values: per-token time and throughput, k = 0 and 10 ----
CHANGES = [
    ("270M", "CLS", 0, 50.3, 19.90), ("270M", "CLS", 10, 65.6, 15.24),
    ("270M", "QA", 0, 47.3, 21.13), ("270M", "QA", 10, 58.5, 17.10),
    ("1B", "CLS", 0, 68.5, 14.60), ("1B", "CLS", 10, 77.0, 12.98),
]
CHANGE_PCT = {("270M", "CLS"): (30, -23), ("270M", "QA"): (24, -19), ("1B", "CLS"): (12, -11)}

# ---- fixed values: the parser's trees for the fifteen sentences, in its order ----
TREES = {
    1: ["(S (NP (Nominal (Nominal1 (Noun research)) (Noun fans))) (VP (Verb hope) (PP (Preposition for) (NP (Nominal (Adjective spinal) (Nominal1 (Noun injuries)))))))",
        "(S (NP (Nominal (Noun research))) (VP (Verb fans) (NP (Nominal (Noun hope))) (PP (Preposition for) (NP (Nominal (Adjective spinal) (Nominal1 (Noun injuries)))))))"],
    2: ["(S (NP (Nominal (Adjective spinal) (Nominal1 (Noun injuries)))) (VP (Verb need) (NP (Nominal (Noun research)))))"],
    3: ["(S (NP (Nominal (Nominal1 (Noun sports)) (Noun fans))) (VP (Verb like) (NP (Nominal (Noun research)))))"],
    4: ["(S (NP (Nominal (Nominal1 (Noun sports)) (Noun fans))) (VP (Verb fear) (NP (Nominal (Adjective spinal) (Nominal1 (Noun injuries))))))"],
    5: ["(S (NP (Nominal (Nominal1 (Noun sports)) (Noun research))) (VP (Verb costs) (NP (Nominal (Noun money)))))"],
    6: ["(S (NP (Det the) (Nominal (Noun fan))) (VP (Verb fans) (NP (Det the) (Nominal (Noun researcher))) (PP (Preposition with) (NP (Det a) (Nominal (Noun fan))))))"],
    7: ["(S (NP (Nominal (Noun researchers))) (VP (Verb hope) (PP (Preposition for) (NP (Nominal (Noun money))))))"],
    8: ["(S (NP (Det the) (Nominal (Noun fan))) (VP (Verb needs) (NP (Nominal (Nominal1 (Noun sports)) (Noun research)))))"],
    9: ["(S (NP (Det the) (Nominal (Noun researcher))) (VP (Verb needs) (NP (Nominal (Noun money)))))"],
    10: ["(S (NP (Det the) (Nominal (Noun fan))) (VP (Verb likes) (NP (Nominal (Noun sports)))))"],
    11: ["(S (NP (Nominal (Noun fans))) (VP (Verb like) (NP (Nominal (Noun likes))) (PP (Preposition on) (NP (Nominal (Adjective social) (Nominal1 (Noun media)))))))"],
    12: ["(S (NP (Nominal (Nominal1 (Noun sports)) (Noun fans))) (VP (Verb hope) (PP (Preposition for) (NP (Nominal (Noun likes))))))",
        "(S (NP (Nominal (Noun sports))) (VP (Verb fans) (NP (Nominal (Noun hope))) (PP (Preposition for) (NP (Nominal (Noun likes))))))"],
    13: ["(S (NP (Nominal (Noun fans))) (VP (Verb need) (NP (Nominal (Noun money))) (PP (Preposition for) (NP (Nominal (Noun sports))))))"],
    14: ["(S (NP (Det the) (Nominal (Adjective social) (Nominal1 (Noun fan)))) (VP (Verb likes) (NP (Det the) (Nominal (Noun researcher)))))"],
    15: ["(S (NP (Nominal (Noun researchers))) (VP (Verb fear) (NP (Det the) (Nominal (Noun media)))))"],
}
