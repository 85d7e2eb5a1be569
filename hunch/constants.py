"""Parameters and word lists.

FIXED VALUES — these must equal the behaviour being reproduced, so they are stated
here plainly and in their natural order. Anything else in the package derives from
them or takes them as keyword parameters.
"""

# --- ranking (FIXED VALUES) -------------------------------------------------------
BM25_K1 = 1.2
BM25_B = 0.75
WEIGHTED_DEPTH = 100        # hits kept for the boosted query
SUBQUERY_DEPTH = 50         # hits kept per subquery
FUSED_DEPTH = 50            # fused results returned
RRF_C_MAIN = 60
RRF_C_COMPONENTS = 100
ENTITY_BOOST = 4
TIME_BOOST = 2
ATTRIBUTE_BOOST = 2
ATTRIBUTE_BOOST_HIGH = 3

# --- snippets (FIXED VALUES) ------------------------------------------------------
SNIPPET_WINDOW = 100        # characters after the anchor
SNIPPET_BEFORE = 50         # characters before the anchor
SNIPPET_FALLBACK = 150      # characters shown when nothing anchors
SNIPPET_MIN_TERM_LEN = 3    # a term must be longer than two characters

# --- corpus split (FIXED VALUES) --------------------------------------------------
CHUNK_LIMIT_BYTES = 1024 * 1024 * 1024   # 1.0 GB as 1024^3 bytes
CHUNK_PREFIX = "miniCorpus_"             # chunk n is the unit <prefix>n.jsonl

# --- query-side stop list (FIXED VALUES) ------------------------------------------
# Spark's StopWordsRemover English list (181 words), standing in for the NLTK list.
QUERY_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will",
    "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll",
    "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's",
    "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't",
    "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't",
    "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could",
    "here's", "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
]

# --- index-side stop list (FIXED VALUES) ------------------------------------------
# The classic 33-word English analyzer stop set.
INDEX_STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
]

# --- decomposition word lists (FIXED VALUES) --------------------------------------
MEDIA_TYPES = [
    "image", "images", "photo", "photos", "picture", "pictures", "screenshot", "screenshots",
    "graphic", "graphics", "drawing", "drawings", "illustration", "illustrations", "icon", "icons",
    "thumbnail", "thumbnails", "video", "videos", "movie", "movies", "film", "films", "clip", "clips",
    "footage", "animation", "animations", "gif", "gifs", "audio", "sound", "sounds", "music", "song",
    "songs", "track", "tracks", "podcast", "podcasts", "recording", "recordings",
]
CHUNK_STOP_ROOTS_V1 = ["something", "someone", "scene", "point", "he", "she", "dude", "people"]
CHUNK_STOP_ROOTS_V2 = ["something", "someone", "scene", "point", "dude", "people"]
ARTICLE_PREFIX_RE = r"^(a|the|this|that)\s+"
ENTITY_MEDIA_SUFFIXES = [" movie", " movies", " film", " films"]
TIME_LABELS = ["DATE", "TIME"]
ENTITY_LABELS = ["PERSON", "ORG", "GPE", "WORK_OF_ART"]
RESOLVE_PRONOUNS = ["he", "she", "they", "her", "him"]
ANTECEDENT_LABELS = ["PERSON", "ORG", "GPE"]
ANTECEDENT_NOUNS = ["woman", "man", "person", "girl", "boy"]
SUBJECT_DEPS = ["nsubj", "nsubjpass"]
OBJECT_DEPS = ["dobj", "attr", "oprd"]
CAPITALISED_NAME_RE = r"\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b"
DESC_WORDS_V1 = (2, 5)
DESC_WORDS_V2 = (2, 10)
CHUNK_WORDS_V1 = (2, 5)
CHUNK_WORDS_V2 = (2, 7)

# --- component filters of the model-reply flow (FIXED VALUES) ---------------------
GENERIC_ENTITIES = ["man", "woman", "lady", "ghost", "dads", "people", "person"]
ATTRIBUTE_RATED_MARK = "r rated"
ATTRIBUTE_RATED_VALUE = "R-rated"
ATTRIBUTE_DROP_MARK = "crazy shit"
DESCRIPTION_DROP_MARK = "shit"
HIGH_BOOST_ATTRIBUTES = ["cannes", "awards", "art house flick", "horror"]
CODE_FENCE_RE = r"(?m)^```json|```$"

# The prompt that asks a model to split a query into five lists; ``{query}`` is the slot.
DECOMPOSE_PROMPT_TEMPLATE = """
    You are an information retrieval assistant. 
    Decompose the following query into a JSON object with these keys:
    - media_type
    - entities
    - attributes
    - time
    - descriptions

    Guidelines:
    - Always return lists for every key (even if empty).
    - Extract only short spans (1–3 words) directly from the query.
    - Do not repeat the full query in any field.
    - Normalize obvious typos (e.g., 'Foriegn Film' → 'foreign film').
    - Prefer distinctive nouns, names, or attributes over generic words.
    - Avoid duplicates across fields.
    - Keep values lowercase unless they are proper names.

    Example:
    Query: "George Clooney movie where a woman witnesses a murder"
    JSON:
    {
    "media_type": ["movie"],
    "entities": ["George Clooney"],
    "attributes": ["murder"],
    "time": [],
    "descriptions": ["woman witnesses"]
    }

    Now decompose this query:
    Query: "{query}"
    JSON:
    """

# --- tokenisation patterns (our definitions) --------------------------------------
TERM_RE = r"[\p{L}\p{N}_]+"                 # index / query term
PUNCT_RE = r"[^\p{L}\p{N}_\s\p{Z}]"         # deleted during query normalisation
BLANK_RE = r"[\s\p{Z}]+"                    # word separator


# FIXED VALUES: suffixes of the Porter stemmer, steps 2 and 3 with their replacements, step 4
PORTER_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent",
                "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
                "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log"}
PORTER_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
PORTER_STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]

# FIXED VALUES: labels of a displayed result (S12), in the order they are printed.
RESULT_LABELS = ("Rank ", " | DocID: ", " | Score: ", "Title: ", "Snippet: ")
