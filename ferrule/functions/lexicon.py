"""Looking up freely typed values in a short list of terms.

A multi-pattern automaton over all spellings finds mentions embedded in a value; of overlapping mentions the longest
wins, of several the first. Values without a mention go to a token-set similarity that allows for typing slips.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import ahocorasick

#: Words that may stand beside a term without changing what is meant.
NEUTRAL = frozenset("the a an of in at for by via and made measured reported average averaged avg mean value values approx this work rt process route method as".split())
#: The least token-set similarity, and its lead over the next term.
LEAST, LEAD = 0.80, 0.02

_GAP = re.compile(r"[\s_\-‐-―/]+")
#: What parts the steps of a route.
_STEPS = re.compile(r"[;,/+(]|\bfollowed by\b|\bthen\b|\bplus\b|\band then\b|\bafter\b|→|->")
_MARKS = re.compile(r"[\"`´‘’“”*†‡#|!?]+")


def visible(text: str) -> str:
    """Compatibility form without invisible characters."""
    text = unicodedata.normalize("NFKC", text)
    return "".join(c for c in text if unicodedata.category(c) not in ("Cf", "Mn", "Cc") or c in "\n\t ")


def key(text: str) -> str:
    """The form under which spellings are compared: folded, single-spaced, separators as spaces."""
    text = _MARKS.sub("", visible(text).casefold().replace("'", ""))
    text = re.sub(r"[.:;,]+(?=\s|$)|[()\[\]{}]", " ", _GAP.sub(" ", text))
    return " ".join(text.split())


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, replace, swap of neighbours) from a to b; most + 1 where there are more."""
    # An edit changes at most two of the letters that occur.
    if abs(len(a) - len(b)) > most or len(set(a) ^ set(b)) > 2 * most:
        return most + 1
    before, row = [0] * (len(b) + 1), list(range(len(b) + 1))
    older = before
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], older[j - 2] + 1)
        if min(row) > most:
            return most + 1
    return row[-1]


def slips(length: int) -> int:
    """Edits that still count as slips in a word of so many letters."""
    return 0 if length < 4 else 1 if length < 6 else 2 if length < 9 else 3


class Lexicon:
    """Terms with their spellings. ``known`` holds further words of the field that are no slips of a term's words."""

    def __init__(self, terms: Iterable[tuple[int, Iterable[str]]], known: Iterable[str] = ()) -> None:
        self.exact: dict[str, int] = {}
        self.sets: dict[tuple[str, ...], int] = {}
        self.squeezed: dict[str, int] = {}
        self.spelled: list[tuple[int, str, tuple[str, ...]]] = []
        self.words: set[str] = set(known)
        self.mentions = ahocorasick.Automaton()
        for number, spellings in terms:
            for s in spellings:
                if not s or not (k := key(s)):
                    continue
                self.exact.setdefault(k, number)
                tokens = tuple(k.split())
                self.sets.setdefault(tuple(sorted(tokens)), number)
                self.squeezed.setdefault(k.replace(" ", ""), number)
                self.spelled.append((number, k, tokens))
                self.words.update(tokens)
                self.mentions.add_word(f" {k} ", (number, len(k)))
        if self.spelled:
            self.mentions.make_automaton()

    def first_mention(self, k: str) -> tuple[int, str, str] | None:
        """The first of the longest non-overlapping mentions in a key, with what stands before and after it."""
        if not self.spelled:
            return None
        padded = f" {k} "
        found = sorted(((end - n, -n, number) for end, (number, n) in self.mentions.iter(padded)))
        taken: list[tuple[int, int, int]] = []
        for start, n, number in sorted(found, key=lambda f: (f[1], f[0])):
            if all(start >= e or start - n <= s for s, e, _ in taken):
                taken.append((start, start - n, number))
        if not taken:
            return None
        start, end, number = min(taken)
        return number, padded[:start].strip(), padded[end:].strip()

    def similar(self, k: str) -> tuple[int, float]:
        """The term of the greatest token-set similarity and that similarity; (0, best) below the least one."""
        best: dict[int, float] = {}
        forms = {tuple(k.split()), tuple(t for t in k.split() if t not in NEUTRAL)} - {()}
        for tokens in forms:
            glued = "".join(tokens)
            foreign = [t for t in tokens if t in self.words]
            for number, spelled, terms in self.spelled:
                score = self._overlap(list(tokens), terms)
                whole = spelled.replace(" ", "")
                most = slips(len(whole)) if len(terms) == 1 else min(len(whole) // 4, 5)
                if most and score < 1 and all(t in terms for t in foreign) and (d := distance(glued, whole, most)) <= most:
                    score = max(score, 1 - 0.75 * d / len(whole))
                best[number] = max(best.get(number, 0.0), score)
        ranked = sorted(best.items(), key=lambda x: -x[1])
        if not ranked or ranked[0][1] < LEAST or len(ranked) > 1 and ranked[0][1] - ranked[1][1] < LEAD:
            return 0, ranked[0][1] if ranked else 0.0
        return ranked[0]

    def _overlap(self, tokens: list[str], terms: tuple[str, ...]) -> float:
        """Twice the letters in matched tokens by all letters; a token that is another known word matches only itself."""
        rest, hit = list(terms), 0.0
        for t in tokens:
            at, gain = None, 0.0
            for i, x in enumerate(rest):
                if t == x:
                    at, gain = i, 2.0 * len(x)
                    break
                if t not in self.words and (most := slips(max(len(t), len(x)))) and (d := distance(t, x, most)) <= most:
                    if (g := (len(t) + len(x)) * (1 - 0.5 * d / len(x))) > gain:
                        at, gain = i, g
            if at is not None:
                hit += gain
                rest.pop(at)
        return hit / (sum(map(len, tokens)) + sum(map(len, terms)) or 1)

    def find(self, text: str | None, first: bool = False) -> tuple[int, str, float]:
        """(term, route, similarity) of a value: term 0 where the list has none.

        ``first``: what follows a mention may be anything, as in a list of steps of which the first counts;
        otherwise words beside the mention must be neutral.
        """
        if text is None or not (k := key(text)):
            return 0, "none", 0.0
        if k in self.exact:
            return self.exact[k], "spelling", 1.0
        if (tokens := tuple(sorted(k.split()))) in self.sets:
            return self.sets[tokens], "token set", 1.0
        if (glued := k.replace(" ", "")) in self.squeezed:
            return self.squeezed[glued], "spelling", 1.0
        mention = self.first_mention(k)
        if first:
            return self._first_step(text, k, mention)
        if mention and all(w in NEUTRAL or w.isdigit() for w in (mention[1] + " " + mention[2]).split()):
            return mention[0], "mention", 1.0
        number, score = self.similar(k)
        return (number, "similarity", score) if number else (0, "none", score)

    def _first_step(self, text: str, k: str, mention: tuple[int, str, str] | None) -> tuple[int, str, float]:
        """A list of steps: its first one, which may be misspelled or foreign to the list."""
        if mention and all(w in NEUTRAL or w.isdigit() for w in mention[1].split()):
            return mention[0], "mention", 1.0
        steps = [s for s in map(key, _STEPS.split(visible(text).casefold())) if s]
        number, score = self.similar(steps[0] if steps else k)
        if number:
            return number, "similarity", score
        if mention and len(steps) > 1 and self.first_mention(steps[0]) is None:
            return 0, "none", score
        return (mention[0], "mention", 1.0) if mention else (0, "none", score)
