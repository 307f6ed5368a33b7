"""English stemmer after the published Snowball "English" (Porter2) description, applied to whole token arrays.

A batch of token arrays is flattened and dictionary-encoded, so Python sees every distinct word of a batch once
and the rest is Arrow kernels. A worker remembers a bounded number of stems from batch to batch. The job is map-only:
tokens are never shuffled to be stemmed.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words with a stem of their own.
IRREGULAR = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
# Words left alone once the plural is off.
SETTLED = {"inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"}

# Suffix replacements of steps 2 and 3, and the suffixes that step 4 deletes.
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "ogi": "og",
    "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "",
    "ness": "", "ative": "",
}
STEP4 = set("al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion".split())
PAST = {"eedly", "eed", "ingly", "edly", "ing", "ed"}
STEMS_KEPT = 1 << 17  # memory bound of a worker
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")

_REGION = re.compile(r"[^aeiouy]*[aeiouy]+[^aeiouy]")
_LONG_PREFIX = re.compile(r"gener|commun|arsen")
_VOWEL = re.compile(r"[aeiouy]")
_SHORT_END = re.compile(r"(?:[^aeiouy][aeiouy][^aeiouywxY]|^[aeiouy][^aeiouy])$")
_INNER_Y = re.compile(r"([aeiouy])y")


def _longest_first(suffixes) -> tuple[str, ...]:
    return tuple(sorted(suffixes, key=len, reverse=True))


_ENDS1, _ENDS2, _ENDS3, _ENDS4 = (_longest_first(s) for s in (PAST, STEP2, STEP3, STEP4))
# Every ending that some rule acts on, without those that end in another one.
_ACTED_ON = {*PAST, *STEP2, *STEP3, *STEP4, "s", "y", "Y", "e", "ll"}
_ACTED_ON = tuple(s for s in _ACTED_ON if not any(s != t and s.endswith(t) for t in _ACTED_ON))


def _suffix(w: str, suffixes: tuple[str, ...]) -> str:
    """The longest of the suffixes that the word ends in, or an empty string."""
    if w.endswith(suffixes):
        for s in suffixes:
            if w.endswith(s):
                return s
    return ""


def _region_start(word: str, start: int) -> int:
    hit = _REGION.match(word[start:])
    return start + hit.end() if hit else len(word)


def stem(word: str) -> str:
    if len(word) <= 2 or not word.endswith(_ACTED_ON) and "Y" not in word:
        return word
    return _stem_by_rules(word)


@functools.lru_cache(maxsize=STEMS_KEPT)
def _stem_by_rules(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    w = word
    if "y" in w:
        w = _INNER_Y.sub(r"\1Y", "Y" + w[1:] if w[0] == "y" else w)
    prefix = _LONG_PREFIX.match(w)
    r1 = prefix.end() if prefix else _region_start(w, 0)
    r2 = _region_start(w, r1)

    w = _plural(w)
    if w in SETTLED:
        return w
    w = _past_tense(w, r1)
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in "aeiouy":
        w = w[:-1] + "i"
    w = _derivation(w, r1, r2)
    if w[-1] == "e":
        if len(w) > r2 or (len(w) > r1 and not _SHORT_END.search(w[:-1])):
            w = w[:-1]
    elif w.endswith("ll") and len(w) > r2:
        w = w[:-1]
    return w.replace("Y", "y")


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith(("ied", "ies")):
        return w[:-3] + ("i" if len(w) > 4 else "ie")
    if w.endswith("s") and not w.endswith(("us", "ss")) and _VOWEL.search(w[:-2]):
        return w[:-1]
    return w


def _past_tense(w: str, r1: int) -> str:
    suffix = _suffix(w, _ENDS1)
    if not suffix:
        return w
    base = w[: -len(suffix)]
    if suffix.startswith("eed"):
        return base + "ee" if len(base) >= r1 else w
    if not _VOWEL.search(base):
        return w
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    if len(base) <= r1 and _SHORT_END.search(base):
        return base + "e"
    return base


def _derivation(w: str, r1: int, r2: int) -> str:
    suffix = _suffix(w, _ENDS2)
    base = w[: len(w) - len(suffix)]
    if suffix and len(base) >= r1:
        allowed = {"li": base[-1:] in tuple("cdeghkmnrt"), "ogi": base.endswith("l")}
        if allowed.get(suffix, True):
            w = base + STEP2[suffix]
    suffix = _suffix(w, _ENDS3)
    base = w[: len(w) - len(suffix)]
    if suffix and len(base) >= (r2 if suffix == "ative" else r1):
        w = base + STEP3[suffix]
    suffix = _suffix(w, _ENDS4)
    base = w[: len(w) - len(suffix)]
    if suffix and len(base) >= r2 and (suffix != "ion" or base.endswith(("s", "t"))):
        w = base
    return w


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_array(tokens: pa.Array) -> pa.Array:
    words = tokens.flatten().dictionary_encode()
    stems = pa.array([stem(w) for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()], words.dictionary.type)
    counts = tokens.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = pa.array([0, *counts.cumsum().tolist()], pa.int32())
    return pa.ListArray.from_arrays(offsets, stems.take(words.indices), mask=tokens.is_null())
