"""English stemmers for single words; the text jobs call them once per distinct token."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# fixed values: irregular forms kept whole by the extended Porter stemmer
PORTER_IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "innings": "inning",
    "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning", "canning": "canning",
    "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# fixed values: suffix rules of the Porter algorithm (1980), longest first within a step
PORTER_STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "fulli": "ful",
}
PORTER_STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
PORTER_STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti",
    "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """Consonants as c, vowels as v; a y after a consonant is a vowel."""
    out = ""
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _swap_longest(word: str, rules: dict[str, str], min_measure: int) -> str:
    for suffix in sorted(rules, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + rules[suffix] if _measure(stem) >= min_measure else word
    return word


def porter(word: str) -> str:
    word = word.lower()
    if word in PORTER_IRREGULAR:
        return PORTER_IRREGULAR[word]
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("ies"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past tense and participles
    if word.endswith("ied"):
        word = word[:-1] if len(word) == 4 else word[:-2]
    elif word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for suffix in ("ed", "ing"):
            stem = word[: -len(suffix)]
            if word.endswith(suffix) and "v" in _shape(stem):
                if stem.endswith(("at", "bl", "iz")):
                    word = stem + "e"
                elif _doubled(stem):
                    word = stem if stem[-1] in "lsz" else stem[:-1]
                else:
                    word = stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
                break
    if word.endswith("y") and len(word) > 2 and _shape(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    # derivational suffixes
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        word = _swap_longest(word[:-2], PORTER_STEP_2, 1)
    elif word.endswith("logi"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        word = _swap_longest(word, PORTER_STEP_2, 1)
    word = _swap_longest(word, PORTER_STEP_3, 1)
    for suffix in sorted(PORTER_STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            if _measure(stem) > 1 and (suffix != "ion" or stem.endswith(("s", "t"))):
                word = stem
            break
    # final e and double l
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _short_end(stem)):
            word = stem
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


# fixed values: word and suffix tables of the Snowball English stemmer
SNOWBALL_SPECIAL = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl",
    "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe",
    "atlas": "atlas", "cosmos": "cosmos", "bias": "bias", "andes": "andes", "inning": "inning", "innings": "inning",
    "outing": "outing", "outings": "outing", "canning": "canning", "cannings": "canning", "herring": "herring",
    "herrings": "herring", "earring": "earring", "earrings": "earring", "proceed": "proceed", "proceeds": "proceed",
    "proceeded": "proceed", "proceeding": "proceed", "exceed": "exceed", "exceeds": "exceed", "exceeded": "exceed",
    "exceeding": "exceed", "succeed": "succeed", "succeeds": "succeed", "succeeded": "succeed", "succeeding": "succeed",
}
SNOWBALL_STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent", "izer": "ize", "ization": "ize",
    "ational": "ate", "ation": "ate", "ator": "ate", "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful",
    "ousli": "ous", "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble", "fulli": "ful",
    "lessli": "less",
}
SNOWBALL_STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
SNOWBALL_STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ism", "ate", "iti", "ous", "ive",
    "ize", "ion",
]
_V = "[aeiouy]"
_C = "[^aeiouy]"


def _regions(word: str) -> tuple[int, int]:
    """Where the regions after the first and the second vowel-consonant step begin."""
    prefix = next((p for p in ("gener", "commun", "arsen") if word.startswith(p)), None)
    step = re.compile(_V + _C)
    found = step.search(word)
    r1 = len(prefix) if prefix else (found.end() if found else len(word))
    found = step.search(word, r1)
    return r1, found.end() if found else len(word)


def _ends_short(word: str) -> bool:
    return bool(re.fullmatch(f"{_V}{_C}", word) or re.search(f"{_C}{_V}[^aeiouywxY]$", word))


def _drop_suffix(word: str, rules: dict[str, str], start: int) -> str:
    for suffix in sorted(rules, key=len, reverse=True):
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            return word[:at] + rules[suffix] if at >= start else word
    return word


def snowball(word: str) -> str:
    word = word.lower().replace("’", "'")
    if len(word) <= 2:
        return word
    if word in SNOWBALL_SPECIAL:
        return SNOWBALL_SPECIAL[word]
    word = word[1:] if word.startswith("'") else word
    word = re.sub(f"(^|{_V})y", lambda m: m.group(1) + "Y", word)
    r1, r2 = _regions(word)
    word = re.sub("('s'|'s|')$", "", word)
    # plurals
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith(("ied", "ies")):
        word = word[:-2] if len(word) > 4 else word[:-1]
    elif word.endswith("s") and not word.endswith(("us", "ss")) and re.search(_V, word[:-2]):
        word = word[:-1]
    # past tense and participles
    tail = re.search("(eedly|eed|ingly|edly|ing|ed)$", word)
    if tail:
        stem = word[: tail.start()]
        if tail.group().startswith("eed"):
            word = stem + "ee" if tail.start() >= r1 else word
        elif re.search(_V, stem):
            if stem.endswith(("at", "bl", "iz")):
                word = stem + "e"
            elif re.search("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$", stem):
                word = stem[:-1]
            else:
                word = stem + "e" if r1 >= len(stem) and _ends_short(stem) else stem
    if len(word) > 2 and word[-1] in "yY" and re.match(_C, word[-2]):
        word = word[:-1] + "i"
    # derivational suffixes
    if word.endswith("logi") and not word.endswith(tuple(SNOWBALL_STEP_2)):
        word = word[:-1] if len(word) - 3 >= r1 else word
    elif word.endswith("li") and not word.endswith(tuple(SNOWBALL_STEP_2)):
        word = word[:-2] if len(word) - 2 >= r1 and re.search("[cdeghkmnrt]li$", word) else word
    else:
        word = _drop_suffix(word, SNOWBALL_STEP_2, r1)
    if word.endswith("ative"):
        word = word[:-5] if len(word) - 5 >= r2 else word
    else:
        word = _drop_suffix(word, SNOWBALL_STEP_3, r1)
    for suffix in sorted(SNOWBALL_STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            at = len(word) - len(suffix)
            if at >= r2 and (suffix != "ion" or word[:at].endswith(("s", "t"))):
                word = word[:at]
            break
    # final e and double l
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not _ends_short(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.lower()


def _stem_texts(stem):
    @F.pandas_udf(StringType())
    def run(words: pd.Series) -> pd.Series:
        return pd.Series([stem(w) for w in words], dtype=object)

    return run


def _stem_lists(stem):
    @F.arrow_udf(ArrayType(StringType()))
    def run(lists: pa.Array) -> pa.Array:
        """Every distinct token of the batch is stemmed once; only the distinct ones become Python strings."""
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        codes = lists.flatten().dictionary_encode()
        stems = pa.array([stem(w) for w in codes.dictionary.to_pylist()], pa.string())
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, stems.take(codes.indices), mask=lists.is_null() if lists.null_count else None)

    return run


STEMMERS = {"porter": porter, "snowball": snowball}


def stem_word(word: Column, stemmer: str = "porter") -> Column:
    return _stem_texts(STEMMERS[stemmer])(word)


def stem_tokens(tokens: Column, stemmer: str = "porter") -> Column:
    """Stems of a token list, row by row and without a shuffle."""
    return _stem_lists(STEMMERS[stemmer])(tokens)
