"""Plain Python versions of the operators, to compare Spark's results with."""

import re
from collections import Counter


def tokens(text, stop=(), vocabulary=None, min_len=3):
    words = [w for w in re.findall("[a-z]+", text.lower()) if len(w) >= min_len]
    return [w for w in words if w not in stop and (vocabulary is None or w in vocabulary)]


def lines(text):
    parts = re.split("\r\n|\r|\n", text)
    return parts[:-1] if parts[-1] == "" else parts


def pairs(texts, d, stop=(), vocabulary=None):
    out = Counter()
    for text in texts:
        words = tokens(text, stop, vocabulary)
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                if 1 <= abs(i - j) <= d:
                    out[a, b] += 1
    return out


class _Word:
    """A word read letter by letter, after the definitions of the 1980 paper."""

    def __init__(self, letters):
        self.letters = letters

    def kinds(self):
        out = ""
        for ch in self.letters:
            if ch in "aeiou":
                out += "V"
            elif ch == "y":
                out += "V" if out.endswith("C") else "C"
            else:
                out += "C"
        return out

    def measure(self):
        return re.sub(r"(.)\1+", r"\1", self.kinds()).count("VC")

    def has_vowel(self):
        return "V" in self.kinds()

    def double(self):
        w = self.letters
        return len(w) > 1 and w[-1] == w[-2] and self.kinds()[-1] == "C"

    def cvc(self):
        return self.kinds()[-3:] == "CVC" and self.letters[-1] not in "wxy"


def _replace(word, rules, above):
    for suffix in sorted(rules, key=len, reverse=True):
        if word.endswith(suffix):
            head = word[: -len(suffix)]
            return head + rules[suffix] if _Word(head).measure() > above else word
    return word


def stem(word, revision="revised"):
    if word.endswith("sses"):
        word = word[:-2]
    elif word.endswith("ies"):
        word = word[:-3] + "i"
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    cut = None
    if word.endswith("eed"):
        if _Word(word[:-3]).measure() > 0:
            word = word[:-1]
    elif word.endswith("ed"):
        cut = word[:-2]
    elif word.endswith("ing"):
        cut = word[:-3]
    if cut is not None and _Word(cut).has_vowel():
        word = cut
        if word.endswith(("at", "bl", "iz")):
            word += "e"
        elif _Word(word).double() and word[-1] not in "lsz":
            word = word[:-1]
        elif _Word(word).measure() == 1 and _Word(word).cvc():
            word += "e"

    if word.endswith("y") and _Word(word[:-1]).has_vowel():
        word = word[:-1] + "i"

    two = {
        "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
        "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize",
        "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
        "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    }
    two |= {"bli": "ble", "logi": "log"} if revision == "revised" else {"abli": "able"}
    word = _replace(word, two, 0)
    three = {
        "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
    }
    word = _replace(word, three, 0)

    four = (
        "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
    )
    for suffix in sorted(four, key=len, reverse=True):
        if word.endswith(suffix) and (suffix != "ion" or word[-4:-3] in ("s", "t")):
            head = word[: -len(suffix)]
            if _Word(head).measure() > 1:
                word = head
            break

    if word.endswith("e"):
        head = _Word(word[:-1])
        if head.measure() > 1 or (head.measure() == 1 and not head.cvc()):
            word = word[:-1]
    if word.endswith("ll") and _Word(word).measure() > 1:
        word = word[:-1]
    return word
