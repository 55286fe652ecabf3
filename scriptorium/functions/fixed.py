"""Word lists that results rest on."""

#: Words that matching leaves out of a text's terms.
MATCH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "can", "can't", "cant", "come", "could", "did", "do", "does",
    "don't", "dont", "for", "from", "get", "go", "good", "got", "had", "has", "have", "he", "her", "his", "how", "i",
    "in", "is", "it", "its", "me", "my", "not", "of", "on", "or", "our", "probably", "she", "should", "that", "the",
    "their", "this", "to", "we", "what", "when", "where", "who", "why", "will", "with", "would", "yes", "you", "your",
)

#: Words that are no candidate terms of a style profile.
STYLE_STOP_WORDS = (
    "a", "an", "the", "and", "you", "that", "this", "with", "for", "are", "but", "not", "have", "your", "what", "they",
    "from", "will", "just", "like", "about", "there", "here", "all", "come", "he", "i'll", "ill", "it's", "its", "now",
    "oh", "well", "yeah", "y'all", "yall", "to", "me", "of", "it", "on", "in", "we", "right", "get", "go", "my", "no",
    "was", "be", "out", "i'm", "im", "don't", "dont", "ain't", "aint", "second", "line",
)

#: What makes the tone of a text casual or formal, and its action that of a shooting script.
INFORMAL_MARKERS = ("don't", "can't", "won't", "I'm", "ain't", "gonna", "wanna", "yeah", "nah", "hey", "okay", "ok", "shit", "dude", "man", "guy", "right")
FORMAL_MARKERS = ("shall", "therefore", "hereby", "whereupon", "thus", "aforementioned", "whereas", "hence", "whom")
ACTION_MARKERS = ("CUT TO", "PAN TO", "FADE IN", "FADE OUT", "DISSOLVE TO", "INT.", "EXT.", "SMASH CUT", "MATCH CUT", "ANGLE ON", "TIGHT ON", "WIDE ON", "CLOSE ON", "POV", "MONTAGE")


def sql_list(words: tuple[str, ...]) -> str:
    """The words as an SQL list."""
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"
