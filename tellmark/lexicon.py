"""Word lists, phrase patterns, templates and limits that decide results.

Everything here is plain text feeding both the Spark expressions and the SQL the
results are checked with, so the two cannot drift apart.
"""

# --- Fixed values: whitespace ------------------------------------------------
# One class with the same members in java.util.regex and RE2, instead of `\s`,
# which is ASCII-only in both and Unicode in the results to match.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NON_WS = "[^" + WS[1:]

# --- Fixed values: tokens ------------------------------------------------------
WORD = "[A-Za-z']+"
LOWER_WORD = "[a-z']+"
SENTENCE_END = "[.!?]"
PUNCTUATION = ".,!?;:'\"()-"
# Decimal digits plus the other characters Unicode gives a digit value.
DIGIT = (
    r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    r"\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}"
    r"\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{1f100}-\x{1f10a}]"
)
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
    r"\x{1F1E0}-\x{1F1FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]"
)

# --- Fixed values: word lists ----------------------------------------------------
GENERIC_ADJECTIVES = [
    "great", "amazing", "perfect", "wonderful", "excellent",
    "fantastic", "awesome", "incredible", "outstanding", "superb",
    "impressive", "remarkable", "exceptional", "stunning", "lovely",
]
HEDGES = [
    "perhaps", "somewhat", "quite", "rather", "pretty", "fairly",
    "relatively", "arguably", "presumably", "supposedly", "seemingly",
]
FIRST_PERSON = ["i", "me", "my", "mine", "myself", "i'm", "i've", "i'd", "i'll"]
# Positive words are the generic adjectives and these.
MORE_POSITIVE = ["love", "loved", "best", "happy", "satisfied", "recommend", "good", "nice"]
NEGATIVE = [
    "bad", "worst", "terrible", "awful", "disappointed",
    "broken", "useless", "waste", "hate", "horrible", "poor",
    "defective", "refund", "returned", "frustrating",
]

# --- Fixed values: phrase patterns, matched on lower-cased text ------------------
TEMPLATE_PHRASES = [
    r"\bi recently purchased\b",
    r"\bi'm blown away\b",
    r"\bblown away by\b",
    r"\boverall,? (i|this|it)\b",
    r"\bi highly recommend\b",
    r"\bhighly recommended\b",
    r"\bi was impressed by\b",
    r"\bi was pleasantly surprised\b",
    r"\bexceeded my expectations\b",
    r"\bgame[- ]changer\b",
    r"\bworth every penny\b",
    r"\bthe perfect (addition|solution|gift|choice)\b",
    r"\bi can('?t| not) recommend.*enough\b",
    r"\bin (conclusion|summary)\b",
    r"\bnot only.*but also\b",
    r"\bsleek (and|design|aesthetic)\b",
    r"\bintuitive (design|interface|features)\b",
    r"\buser[- ]friendly\b",
    r"\btop[- ]notch\b",
    r"\bvalue for money\b",
    r"\bmust[- ]have\b",
]
PERSONA_PHRASES = [
    r"\bas a (busy )?parent\b",
    r"\bas a (college )?student\b",
    r"\bas a (tech )?enthusiast\b",
    r"\bas a (first[- ]time )?buyer\b",
    r"\bas a frequent shopper\b",
    r"\bas a retiree\b",
    r"\bas a gift giver\b",
]
REFUSALS = [
    "as an ai", "i cannot", "i can't write", "i'm unable", "i am unable",
    "here's a", "here is a", "sure,", "certainly,", "i don't feel comfortable",
    "i do not feel comfortable", "of course,",
]
PREAMBLES = ["here's", "here is", "sure,", "okay,", "ok,"]
PREAMBLE_ENDS = [":\n", ": ", ".\n"]
PREAMBLE_REACH = 40

# --- Fixed values: openers and layout marks, on the text as written --------------
RATING_OPENERS = [
    r"\d\s*[/\\]\s*\d\s*stars?",
    r"\d\s*stars?\s*[!.:]?",
    r"★+",
    r"\*+",
    r"rating\s*[:\-]\s*\d",
    r"⭐+",
]
MARKDOWN = r"\*\*[^*]+\*\*|^#{1,3}\s|^\s*[-*]\s"
PROS_CONS = r"\bpros\s*[:\-]|\bcons\s*[:\-]"

# --- Fixed values: prompt planning ------------------------------------------------
CATEGORIES = [
    "Home_and_Kitchen", "Electronics", "Books", "Clothing_Shoes_and_Jewelry",
    "Sports_and_Outdoors", "Toys_and_Games", "Beauty", "Pet_Supplies",
    "Grocery_and_Gourmet_Food", "Office_Products",
]
PERSONAS = [
    "busy parent", "college student", "retiree", "tech enthusiast",
    "first-time buyer", "gift giver", "frequent shopper",
]
LENGTH_HINTS = [
    "Keep it under 20 words", "Around 30-50 words",
    "Around 80-120 words", "A detailed 150-200 word review",
]
PROMPTS = [
    "Write a {stars}-star Amazon review for a {category} product. {length_hint}. Just the review, no preamble.",
    "You bought a {category} item. Write a {stars}-star review as a {persona}. {length_hint}.",
    "Write a genuine-sounding {stars}-star product review for something in {category}. {length_hint}. Do not start with 'I'.",
    "Review a {category} product you recently purchased. Rating: {stars}/5. {length_hint}.",
]
STAR_WEIGHTS = {1: 1, 2: 1, 3: 1, 4: 3, 5: 6}
TEMPERATURE = (0.5, 1.2)

# --- Fixed values: limits ---------------------------------------------------------
WORD_LIMITS = (5, 300)
SHINGLE_WORDS = 5
NEAR_DUPLICATE_JACCARD = 0.6
NUM_PERM = 64
MAX_PERPLEXITY = 1e6
PARAGRAPH_UNIFORMITY = 0.6
SUPERLATIVE_GAP = 5
SUPERLATIVE_DENSITY = 0.01
REQUEST_CHARS = 512
SHORTEST_REQUEST = 5
UNCERTAIN_FROM = 0.35
HIGHLIGHT_FROM = 0.65
VERY_LIKELY_FROM = 0.85
TOP_REASONS = 5
TOP_SPANS = 5
SPAN_CHARS = 3
SPAN_LETTERS = 0.6
MAX_FPR = 0.05
ALARM_FPR = 0.10
MAX_F1_GAP = 0.10
SWEEP = (0.30, 0.90, 61)

# --- Fixed values: column names ---------------------------------------------------
NON_FEATURES = ["text", "label", "category", "rating", "_model", "_temp", "__index_level_0__"]
PERPLEXITY_FEATURES = ["perplexity", "mean_sentence_perplexity", "burstiness"]
TEXT_STYLE_FEATURES = [
    "type_token_ratio", "mean_sentence_length", "std_sentence_length", "mean_word_length",
    "punctuation_density", "exclamation_ratio", "question_ratio", "caps_ratio",
    "generic_adjective_ratio", "hedging_ratio", "first_person_ratio", "digit_ratio", "word_count",
]
TEXT_RULE_FEATURES = [
    "rule_template_hits", "rule_buyer_persona_phrases", "rule_starts_with_rating",
    "rule_markdown_artifacts", "rule_pros_cons_structure", "rule_superlative_density",
    "rule_sentiment_rating_mismatch", "rule_emoji_count", "rule_avg_paragraph_perfection",
]
NEAR_DUPLICATE_FEATURES = ["rule_near_duplicate", "rule_max_jaccard"]
FEATURES = (
    ["base_prob"] + PERPLEXITY_FEATURES + TEXT_STYLE_FEATURES
    + TEXT_RULE_FEATURES + NEAR_DUPLICATE_FEATURES
)

# --- Fixed values: reason wording -------------------------------------------------
# Typical human values behind the reason gates; `human_norms` recomputes them for a corpus.
HUMAN_NORMS = {
    "perplexity": 86.0,
    "mean_sentence_perplexity": 240.0,
    "burstiness": 230.0,
    "type_token_ratio": 0.81,
}
# feature: (side of the norm that reads as human, wording); {v} value, {n} norm.
STYLE_REASONS = {
    "perplexity": (-1, "Statistically too predictable (perplexity {v:.1f} vs ~{n:.0f} for typical human reviews) — the wording follows common LLM patterns."),
    "mean_sentence_perplexity": (-1, "Sentences are individually too predictable ({v:.1f} vs ~{n:.0f}) — characteristic of generated text."),
    "burstiness": (-1, "Sentence rhythm is unnaturally uniform (burstiness {v:.1f} vs ~{n:.0f}); humans alternate predictable and surprising phrasing."),
    "type_token_ratio": (-1, "Vocabulary is less varied than typical human reviews ({v:.2f} vs ~{n:.2f})."),
    "word_count": (+1, "Length and structure resemble templated AI output ({v:.0f} words)."),
    "first_person_ratio": (+1, "Heavy use of first-person pronouns ({v:.0%}) — common when an LLM is prompted to write 'as a buyer'."),
    "mean_sentence_length": (-1, "Sentence length pattern matches typical AI output."),
    "std_sentence_length": (-1, "Sentence-length variance is unusually low for human writing."),
    "mean_word_length": (+1, "Word-length distribution skews longer than typical for human reviews."),
    "punctuation_density": (+1, "Punctuation usage is unusually formal for a customer review."),
    "exclamation_ratio": (-1, "Exclamation usage is muted in a way typical of LLM output."),
    "caps_ratio": (-1, "Lacks the casual capitalization patterns humans typically use."),
    "generic_adjective_ratio": (+1, "Heavy use of generic praise words like \"amazing\" / \"perfect\" / \"great\"."),
    "digit_ratio": (-1, "No specific numbers (sizes, dates, prices) — humans usually mention these."),
    "hedging_ratio": (+1, "Frequent hedging language (\"perhaps\", \"quite\", \"rather\") typical of polished LLM prose."),
    "question_ratio": (-1, "No rhetorical questions — humans often use these."),
}
# feature: (smallest value that fires, wording).
RULE_REASONS = {
    "rule_template_hits": (1, "Contains {v:.0f} phrase(s) commonly seen in AI-generated reviews."),
    "rule_buyer_persona_phrases": (1, "Contains a 'buyer persona' phrase (e.g. 'as a busy parent') typical of LLM prompts."),
    "rule_starts_with_rating": (1, "Opens with a rating-style header ('5/5 stars', '★★★★★')."),
    "rule_markdown_artifacts": (1, "Contains leftover markdown formatting from LLM output."),
    "rule_pros_cons_structure": (1, "Uses formal Pros/Cons section structure — unusual for casual reviews."),
    "rule_emoji_count": (1, "Uses emojis in a pattern typical of recent LLM outputs."),
    "rule_near_duplicate": (1, "Closely matches another review in this dataset (potential template reuse)."),
    "rule_avg_paragraph_perfection": (PARAGRAPH_UNIFORMITY, "Paragraph lengths are unusually uniform — characteristic of generated text."),
    "rule_superlative_density": (SUPERLATIVE_DENSITY, "Clusters of superlatives close together — typical AI praise pattern."),
    "rule_sentiment_rating_mismatch": (1, "Sentiment of the text doesn't match the star rating."),
}
COMBINED_REASON = "Combined statistical signals match patterns common in AI-generated reviews."
HUMAN_SUMMARY = "This review reads like a normal human-written review. No suspicious patterns were detected."
MIXED_SUMMARY = "The signals are mixed — this review has some AI-like qualities but isn't a clear case either way."
PATTERN_SUMMARY = "This review shows several patterns common in AI-generated text."
DISPLAY_LABELS = {"human": "User Description", "ai": "AI Generated Feedback"}
