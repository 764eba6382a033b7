"""The published Porter (1980) suffix-stripping stemmer, for one word at a time.

A small per-word helper: Spark runs it through an Arrow-batched pandas UDF on
the table of distinct words only (see ``operators.stemming``).
"""

from __future__ import annotations

VOWELS = frozenset("aeiou")

# Suffix rules of the published algorithm, in its order.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
         "ism", "ate", "iti", "ous", "ive", "ize"]


def _is_cons(w: str, i: int) -> bool:
    c = w[i]
    if c in VOWELS:
        return False
    if c == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def measure(stem: str) -> int:
    """Number of vowel-consonant sequences in ``stem``."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        cons = _is_cons(stem, i)
        if cons and prev_vowel:
            m += 1
        prev_vowel = not cons
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return (len(w) >= 3 and _is_cons(w, len(w) - 3) and not _is_cons(w, len(w) - 2)
            and _is_cons(w, len(w) - 1) and w[-1] not in "wxy")


def _replace(w: str, rules, min_m: int) -> str:
    for suf, rep in rules:
        if w.endswith(suf):
            stem = w[: len(w) - len(suf)]
            return stem + rep if measure(stem) > min_m else w
    return w


def stem(word: str) -> str:
    """Stem one lower-cased word; words of two letters or fewer are returned as they are."""
    w = word.lower()
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # steps 2 and 3
    w = _replace(w, STEP2, 0)
    w = _replace(w, STEP3, 0)
    # step 4
    for suf in STEP4:
        if w.endswith(suf):
            s = w[: len(w) - len(suf)]
            if measure(s) > 1 and (suf != "ion" or (s and s[-1] in "st")):
                w = s
            break
    # step 5a
    if w.endswith("e"):
        s = w[:-1]
        m = measure(s)
        if m > 1 or (m == 1 and not _cvc(s)):
            w = s
    # step 5b
    if measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w
