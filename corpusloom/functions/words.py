"""Word-level column expressions. All of them run inside the JVM, one row at a time, without a shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop list that Spark ships with StopWordsRemover.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself "
    "it its itself they them their theirs themselves what which who whom this that these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until while of at by for with "
    "about against between into through during before after above below to from up down in out on off over under again "
    "further then once here there when where why how all any both each few more most other some such no nor not only "
    "own same so than too very s t can will just don should now "
    "i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're "
    "i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't "
    "shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's "
    "who's why's would"
).split()

# Two-letter foreign articles and abbreviations dropped on top of the stop list.
EXTRA_STOP_WORDS = ["al", "cd", "et", "en", "el", "da", "de", "lo", "la", "le", "rt"]

# Terms that mark an article as being about diagnostics or surveillance.
RELATED_TERMS = [
    "diagnostic", "diagnostics", "symptomatic", "diagnosing", "diagnosis", "clinical", "diagnose", "diagnoses",
    "detection", "screening", "analytical", "assessment", "prognosis", "surveillance", "monitoring", "reconnaissance",
]

# The 28 punctuation marks that remove_punctuation deletes.
PUNCTUATION = "!()-[]{};:'\"\\,<>./?@#$%^&*_~"

# A run of word characters that are not decimal digits; digits end a token.
ALPHABETIC_RUN = r"[\p{L}\p{Nl}\p{No}_]+"
# A run of word characters, digits included.
WORD_RUN = r"[\p{L}\p{N}_]+"


def token_array(text: Column, min_len: int = 2, max_len: int = 15) -> Column:
    """Lower-cased alphabetic tokens in text order; a leading underscore disqualifies a token."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(ALPHABETIC_RUN), F.lit(0))
    return F.filter(runs, lambda w: F.length(w).between(min_len, max_len) & ~w.startswith("_"))


def drop_words(tokens: Column, words: list[str]) -> Column:
    """Tokens without the given words. `isin` on a literal list becomes one hash lookup per token."""
    return F.filter(tokens, lambda w: ~w.isin(list(words)))


def keep_long(tokens: Column, min_len: int = 2) -> Column:
    return F.filter(tokens, lambda w: F.length(w) >= min_len)


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD_RUN)).cast("bigint")


def split_without_punctuation(text: Column) -> Column:
    """Text without punctuation marks, split at every single space; case and empty strings stay."""
    return F.split(F.translate(text, PUNCTUATION, ""), " ", -1)


def mentions_any(text: Column, terms: list[str]) -> Column:
    """Case-sensitive substring test; the OR chain stops at the first hit."""
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])
