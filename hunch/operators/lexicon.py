"""Word lists of the shallow rule annotator (our own definitions, not fixed values
of anything reproduced). Each word sits in exactly one closed class."""

DET = ["a", "an", "the", "this", "that", "these", "those", "his", "her", "its", "their", "my", "your",
       "our", "some", "any", "every", "each", "another", "no"]
PRON = ["i", "me", "you", "he", "him", "she", "it", "we", "us", "they", "them", "who", "whom", "what",
        "which", "someone", "something", "somebody", "anyone", "anything", "everyone", "everything",
        "nobody", "nothing", "himself", "herself", "itself", "themselves", "myself", "yourself", "ourselves"]
ADP = ["of", "in", "on", "at", "by", "for", "with", "about", "against", "between", "into", "through",
       "during", "before", "after", "above", "below", "to", "from", "up", "down", "off", "over", "under",
       "near", "across", "behind", "beyond", "inside", "outside", "toward", "towards", "without", "within",
       "around", "along", "among", "upon", "like", "onto", "via"]
CCONJ = ["and", "or", "but", "nor", "yet"]
SCONJ = ["where", "when", "while", "because", "if", "although", "though", "since", "unless", "whereas",
         "whether", "until", "as", "so", "than"]
AUX = ["is", "are", "was", "were", "be", "been", "being", "am", "have", "has", "had", "do", "does", "did",
       "will", "would", "can", "could", "should", "shall", "may", "might", "must"]
PART = ["not", "never", "n't"]
ADV = ["very", "too", "also", "just", "then", "there", "here", "now", "always", "often", "later", "again",
       "only", "still", "even", "soon", "almost", "ever", "quite", "rather", "really", "maybe"]
ADJ = ["old", "new", "young", "big", "small", "little", "long", "short", "red", "blue", "green", "black",
       "white", "dark", "bright", "good", "bad", "great", "first", "last", "other", "same", "few", "many",
       "much", "more", "most", "scary", "funny", "strange", "famous", "weird", "main", "whole", "early", "late"]
NEGATIONS = ["not", "never", "n't"]

# The order closed classes are tried in.
CLOSED = [("DET", DET), ("PRON", PRON), ("ADP", ADP), ("CCONJ", CCONJ), ("SCONJ", SCONJ), ("AUX", AUX),
          ("PART", PART), ("ADV", ADV), ("ADJ", ADJ)]

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december"]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
DATE_WORDS = ["today", "yesterday", "tomorrow"]
TIME_WORDS = ["tonight", "morning", "evening", "night", "afternoon", "midnight", "noon"]
YEAR_RE = r"^(1[5-9][0-9][0-9]|20[0-9][0-9])$"
DECADE_RE = r"^([0-9]0s|1[5-9][0-9]0s|20[0-9]0s)$"

ORG_WORDS = ["inc", "corp", "corporation", "company", "university", "college", "school", "institute",
             "studios", "pictures", "records", "band", "club", "team", "agency", "license", "foundation",
             "group", "bank", "church"]
GPE_NAMES = ["america", "england", "britain", "france", "germany", "spain", "italy", "china", "japan",
             "india", "canada", "mexico", "russia", "london", "paris", "berlin", "tokyo", "rome", "madrid",
             "california", "texas", "new york", "los angeles", "chicago"]

ADJ_SUFFIX_RE = r"(ous|ful|ive|able|ible|less|ish)$"
TOKEN_RE = r"[\p{L}\p{N}_]+(?:['’][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s\p{Z}]"
SENTENCE_RE = r"[^.!?]+[.!?]*"
