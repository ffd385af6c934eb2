"""Prompt texts and chat templates.

Fixed values: instruction texts, example layouts and the chat template the
reference used, stated as text.
"""

# ---- fixed values: few-shot layouts ----
TASK_LAYOUTS = {
    "classification": {
        "base": ("Classify the following news article into one of these categories: "
                 "World, Sports, Business, Science/Technology."),
        "fields": ["text", "label"],
        "example": "\nExample %d:\nText: %s\nCategory: %s\n",
        "query": "\nText: %s\nCategory:",
        "query_cols": ["text"],
    },
    "question_answering": {
        "base": ("Read the passage and answer the question. If the answer is not in the "
                 "passage, say 'unanswerable'."),
        "fields": ["context", "question", "answer"],
        "example": "\nExample %d:\nContext: %s\nQuestion: %s\nAnswer: %s\n",
        "query": "\nContext: %s\nQuestion: %s\nAnswer:",
        "query_cols": ["context", "question"],
    },
}

# ---- fixed values: the reference's classification examples ----
CLASSIFICATION_EXAMPLES = [
    ("The stock market closed higher today as investors showed optimism about the latest "
     "tech earnings.", "Business"),
    ("The football team secured a 3-1 victory in the championship game last night.", "Sports"),
    ("NASA announced a new mission to explore the outer reaches of our solar system.",
     "Science/Technology"),
    ("World leaders met today to discuss climate change policies at the United Nations.",
     "World"),
]

# ---- fixed values: the reference's question-answering examples ----
QA_EXAMPLES = [
    ("Machine learning is a subfield of artificial intelligence that focuses on enabling systems to learn "
     "from data without being explicitly programmed.",
     "What does machine learning focus on?",
     "enabling systems to learn from data without being explicitly programmed."),
    ("The Eiffel Tower is located in Paris, France, and was completed in 1889.",
     "Where is the Statue of Liberty located?", "unanswerable"),
    ("Water boils at 100 degrees Celsius under standard atmospheric pressure.",
     "At what temperature does water boil?", "100 degrees Celsius."),
]

# ---- fixed values: conversation texts ----
QA_SYSTEM = "You are a knowledgeable assistant that answers factual questions."
QA_USER_PREFIX = "Answer the following question based on the context:\n\n"
CLS_SYSTEM = "You are a helpful assistant that performs text classification tasks."
CLS_USER_PREFIX = "Classify the sentiment or topic of the following text:\n\n"

# ---- fixed values: turn-marker chat template used for training text ----
TURN_TEMPLATE = {
    "roles": {"user": "user", "assistant": "model", "model": "model"},
    "turn_start": "<start_of_turn>",
    "turn_end": "<end_of_turn>\n",
    "system_sep": "\n\n",
    "generation_prompt": "<start_of_turn>model\n",
}

# ---- fixed values: prompt variants of the summarisation exercise ----
PROMPT_VARIANTS = [
    {"name": "zero-shot", "system": "You are a helpful museum guide.", "user": "{task}"},
    {"name": "role+style", "system": "You are a witty museum educator for teenagers.",
     "user": "{task} Use vivid, friendly language and one metaphor."},
    {"name": "cot-steps", "system": "You are a precise art historian.",
     "user": "Outline 3 key points (artist, context, significance) and then write the label. {task}"},
    {"name": "few-shot",
     "system": ("You are an assistant that converts step-by-step instructions or procedures "
                "into concise, actionable checklists."),
     "user": ("Convert the following instructions into a checklist, checklist needs to be "
              "concise: {task}"),
     "examples": [
         {"role": "user", "content": (
             "First, preheat the oven to 180°C. Then, mix flour, sugar, and butter. Next, add "
             "two eggs and stir well. Finally, pour the batter into a tray and bake for 25 "
             "minutes.")},
         {"role": "assistant", "content": (
             "- Preheat oven to 180°C\n- Mix flour, sugar, and butter\n- Add two eggs and "
             "stir\n- Pour batter into tray\n- Bake for 25 minutes")},
         {"role": "user", "content": (
             "To set up your new phone, start by inserting the SIM card. Then connect to "
             "Wi-Fi. After that, log into your Google account. Lastly, restore your backup "
             "from the cloud.")},
         {"role": "assistant", "content": (
             "- Insert SIM card\n- Connect to Wi-Fi\n- Log into Google account\n- Restore "
             "backup from cloud")},
     ]},
]
