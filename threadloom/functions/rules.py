"""Values of the scoring rules, and the columns of a scoring table."""

# Fixed values of the scoring rules.
NEGATION_FACTOR = -0.74
CAPITALS_STEP = 0.733
NORMALISER = 15
BUT_BEFORE, BUT_AFTER = 0.5, 1.5
EXCLAMATION_STEP, EXCLAMATION_MAX = 0.292, 4
QUESTION_STEP, QUESTION_MAX, QUESTION_MANY = 0.18, 3, 0.96
DISTANCE_DAMPING = [1.0, 0.95, 0.9]
NEVER_SO = {2: 1.5, 3: 1.25}
VADER_SHARE, POLARITY_SHARE = 0.7, 0.3

SCORING_COLUMNS = ["valence", "booster", "negation", "polarity", "subjectivity", "idiom", "intensity"]

# Phrases of a scoring table, of two and three words, around a word with a valence: (words of the phrase, words from the
# scored word back to its first one). An idiom gives its own score; where there are several, the first of these counts.
IDIOM_PLACES = [(3, 0), (2, 0), (2, 1), (3, 2), (2, 2), (3, 3), (2, 3)]
BOOSTER_PLACES = [(3, 3), (2, 3), (2, 2)]
PHRASE_DISTANCE = 3  # words in front that there must be, the farthest without a valence
NO_SCORE_BEFORE = ("kind", "of")  # the first has no score of its own before the second

# Polarity where a scoring table has intensities: words that negate, and what they and an exclamation mark make of a polarity.
POLARITY_NEGATIONS = ("no", "not", "never")
POLARITY_NEGATED, POLARITY_EXCLAIMED = -0.5, 1.25
SHORT = 2  # letters of words across which a modifier reaches
ADVERB = "ly"  # ending of modifiers that take a negation after them as their own
