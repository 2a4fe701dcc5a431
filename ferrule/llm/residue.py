"""Template residue, filler, error pages and script notices in place of content.

Positive-unlabelled learning: passages that fit one of a few fixed signs (:data:`TRUSTED`) are labelled positive, all
others are unlabelled. A naive Bayes classifier over words, pairs of neighbours and the shapes of markup is learnt from
them by expectation-maximization; the labels are used in learning only. Every passage, labelled or not, is scored by the
classifier alone, and a record is residue if one of its passages is.

A text is encoded once: the encoded tokens are what is written, and each round reads.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrule.session import cut

#: Features are hashed into so many buckets: the size of the model, whatever the corpus.
BUCKETS = 1 << 20
#: Rounds of expectation and maximization after the first estimate. More rounds drift from residue to what stands beside it.
ROUNDS = 1
#: Weight of the background in either class: as a share of the class, and in occurrences of a feature.
BACKGROUND, SMOOTHING = 2.0, 2.0
#: Tokens of the window by which a passage is judged, ideographs counting half; and how much less its features count for
#: each token, as they depend on each other.
WINDOW, DEPENDENCE = 10, 0.05
#: How much more frequent in residue a feature must be to speak for it, as a logarithm: many features that are a little
#: more frequent, as all of a sentence that holds a slot once in a while, say nothing.
TELLING = 1.0
#: Log odds by which the expectation is held back, and from which a passage counts as residue.
HELD_BACK, LEAST = 5.0, 1.0

# Signs of residue beyond doubt, each with the pieces of words without which it can't be there. Template
# slots of common syntaxes, printers' filler, and messages of the HTTP standard and of browsers.
TRUSTED: dict[str, tuple[tuple[str, ...], str]] = {
    "braces": (("{{",), r"\{\{[^{}\n]{1,60}\}\}"),
    "format": (("%(",), r"%\([a-z]\w*\)[sd]"),
    "shell": (("${",), r"\$\{[a-z]\w{2,}\}(?!_)"),
    "brackets": (("[insert", "[todo", "[tbd", "[placeholder"), r"\[(?:insert|todo|tbd|placeholder)\b[^\[\]\n]{0,60}\]"),
    "object": (("[object",), r"\[object object\]"),
    "later": (("added", "written", "inserted", "filled"), r"(?:^|\(|: )(?:\w+ )?to be (?:added|written|inserted|filled in)\W*$"),
    "latin": (("lorem", "ipsum"), r"\b(?:lorem|ipsum)\b"),
    "filler": (("placeholder", "dummy", "blindtext", "copy", "goes"), r"\b(?:placeholder|dummy) (?:text|paragraph)|^blindtext|^(?:body )?(?:copy|text) (?:to follow|goes here)"),
    "same": (("xxxx", "____", "????"), r"(?<![\w.?])(?:x{4,}|_{4,}|\?{4,})(?!\w)"),
    "void": (("nan", "undefined", "null", "none"), r"(?<![\w\"'.])(?:nan|undefined|null|none) (?:%|°c|k\b|[mg]pa\b|hv\b|[nμm]?m\b|ppm\b|h\b)"),
    "http": (("found", "forbidden", "unavailable", "gateway", "gone", "error", "denied", "[4", "[5", "requests", "available"), r"^this (?:document|page|article|file) is no longer available|^\[[45]\d\d\]|^too many requests|^(?:the )?service is (?:\w+ )?unavailable|^(?:error )?(?:4\d\d|5\d\d)\W{1,3}(?:page )?(?:not found|forbidden|service unavailable|bad gateway|gone|internal server error)|^access denied\W*$|^page not found\W*$"),
    "trace": (("traceback",), r"^traceback \(most recent call last\)"),
    "script": (("script", "scripts", "scripting", "javascript", "skripte"), r"\b(?:enable|allow|requires?|needs?|without) (?:javascript|scripts?|scripting)\b|(?:javascript|scripting) is (?:disabled|required|switched off)|(?:java)?script aktivieren|aktivieren sie (?:java)?script|skripte zugelassen"),
    "browser": (("browser",), r"^checking your browser|your browser (?:is blocking|does not support)"),
    "wrong": (("wrong", "oops", "whoops", "sorry", "unable"), r"^something went wrong|^(?:wh)?oops\b|^sorry, |^unable to connect"),
    "again": (("again", "session", "erneut"), r"^(?:please )?try again later|^your session has expired|^bitte versuchen sie es (?:später|erneut)"),
    "german": (("gefunden", "erreichbar"), r"seite wurde nicht gefunden|dienst ist (?:\w+ )?nicht erreichbar"),
    "chinese": (("页面未找到", "请稍后再试", "脚本", "此处填写"), r"页面未找到|请稍后再试|请(?:启用|开启).{0,8}脚本|(?:不支持|禁用)脚本|此处填写"),
}
_SIGNS = [(1 << i, re.compile(pattern, re.M)) for i, (_, pattern) in enumerate(TRUSTED.values())]
_PIECES = ahocorasick.Automaton()
for _i, (_pieces, _) in enumerate(TRUSTED.values()):
    for _p in _pieces:
        _PIECES.add_word(_p, (len(_p), _p.isascii() and _p.isalpha(), 1 << _i | (_PIECES.get(_p)[2] if _p in _PIECES else 0)))
_PIECES.make_automaton()
#: A chunk said so many times on end is trusted to be filler.
OVER_AND_OVER = 4

# Encoding ---------------------------------------------------------------------------------------------------------------

_TOKEN = re.compile(r"[一-鿿]|[^\W\d_一-鿿]+|\d+(?:[.,]\d+)*|_|[^\w\s]")
#: Characters whose surroundings are features of their own.
MARKUP = "{}[]<>%$@#_«»‹›?…*|&~^=\\"
#: Notation of the field, which stands for itself: math with subscripts, indices of planes and directions, sets.
_NOTATION = re.compile(r"[^\w$\\{\[<(]*(?:\$(?:[^$\w]|\w(?=[^\w$]|_\{)|\\\w+)[^$]*\$|[A-Za-z]*\\[a-z]+.*|\w+[_^]\{.*\}|[{\[<(](?![45]\d\d)-?\d[\d -]+[}\]>)]|\{[A-Z0-9][a-z]?,|[A-Z0-9][a-z]?\}|\[[a-z]+\]|[#@]\d*)[^\w$]*")
_LEX, _SHAPE = 19, 11
_EDGE, _SAME, _SMALL, _IDEOGRAPH = (1 << _LEX) - 1, 8, 9, 14
_LINE, _TEXT = "\x01", "\x02"
#: Codes below zero: the end of an unlabelled and of a trusted passage; in chunks, an end that the next chunk decides, and the end of a text.
END, END_TRUSTED, _MAYBE, _DONE = -1, -2, -3, -4
#: Letters that are encoded at once, codes that are read at once, and codes of chunks that a task remembers.
SLICE, CODES, REMEMBERED = 4_000_000, 1_000_000, 1_000_000


def shape(token: str) -> int:
    """The shape of a token: its length if a number, its case if a word, itself if a sign."""
    c = token[0]
    if c.isdigit():
        return 6 if not token.isdigit() else 1 + min(len(token), 4)
    if c.isalpha():
        if "一" <= c <= "鿿":
            return _IDEOGRAPH
        if len(token) > 1 and len(set(token.lower())) == 1:
            return _SAME
        return _SMALL if token.islower() else 13 if len(token) == 1 else 10 if token.isupper() else 11 if token[1:].islower() else 12
    return ord(c) if ord(c) < 128 else 128 + ord(c) % 800


@lru_cache(maxsize=200_000)
def _code(token: str, glued: bool) -> int:
    """A token's hash and shape, and whether it follows the one before without a space, in 31 bits."""
    if shape(token) == _SAME:
        word = token[0].casefold() * min(len(token), 4)
    else:
        word = f"#{shape(token)}" if token[0].isdigit() and len(token) != 3 else token.casefold()
    return (zlib.crc32(word.encode()) % _EDGE) << _SHAPE | shape(token) << 1 | glued


_MARKED = np.zeros(1 << _SHAPE, bool)
for _c in [shape(c) for c in MARKUP] + [_SAME]:
    _MARKED[[_c << 1, _c << 1 | 1]] = True


class Chunks(dict):
    """Chunks between spaces to their numbers; the codes of all chunks lie in one array."""

    def __init__(self) -> None:
        self.codes: list[int] = []
        self.starts: list[int] = [0]
        self.signs: list[int] = []
        self.words: list[bool] = []
        for chunk, code in ((_LINE, END), (_TEXT, _DONE)):
            self._add(chunk, [code])

    def _add(self, chunk: str, codes: list[int]) -> int:
        self.codes += codes
        self.starts.append(len(self.codes))
        low = chunk.lower()
        signs = 0
        for end, (n_, word, bits) in _PIECES.iter(low):
            inside = low[max(0, end - n_) : end - n_ + 1].islower() and end >= n_ or low[end + 1 : end + 2].islower()
            signs |= 0 if word and inside else bits
        self.signs.append(signs)
        self.words.append(len(chunk) > 1 and chunk.isalpha())
        self[chunk] = n = len(self.starts) - 2
        return n

    def __missing__(self, chunk: str) -> int:
        codes: list[int] = []
        for i, t in enumerate(["±"] if _NOTATION.fullmatch(chunk) else _TOKEN.findall(chunk)):
            codes.append(_code(t, i > 0))
            if t in "。！？":
                codes.append(END)
        if len(chunk) > 1 and chunk[-1] in ".!?" and chunk[-2] != ".":
            codes.append(_MAYBE)
        return self._add(chunk, codes)


def _flat(text: str | None) -> str:
    return text.replace(_TEXT, " ").replace("\n", f" {_LINE} ") if text else ""


def trusted_chunks(text: str, signs: int) -> list[int]:
    """Numbers of the chunks of a text at which one of ``signs`` begins."""
    low, found = text.lower(), []
    for bit, pattern in _SIGNS:
        for m in pattern.finditer(low) if signs & bit else ():
            inside = m.start() > 0 and not low[m.start() - 1].isspace()
            found.append(len(_flat(low[: m.start()]).split()) - inside)
    return found


def encode(texts: Sequence[str | None], known: Chunks) -> list[np.ndarray]:
    """The codes of each text's tokens; each passage ends with END or, if it has a sign of residue, END_TRUSTED."""
    chunks = "".join(f"{_flat(t)} {_TEXT} " for t in texts).split()
    at = np.fromiter(map(known.__getitem__, chunks), dtype=np.int64, count=len(chunks))
    last = np.flatnonzero(at == known[_TEXT])
    marks = np.zeros(len(chunks), bool)
    first = np.append(0, last[:-1] + 1)[: len(last)]
    signs = np.bitwise_or.reduceat(np.array(known.signs)[at], first) if len(at) else first
    for i in np.flatnonzero(signs):
        marks[[min(first[i] + c, last[i]) for c in trusted_chunks(texts[i], signs[i])]] = True
    run = np.ones(max(0, len(at) - OVER_AND_OVER + 1), bool)
    for k in range(1, OVER_AND_OVER):
        run &= (at[: len(run)] == at[k : k + len(run)]) & (at[: len(run)] > 1)
    marks[: len(run)] |= run & np.array(known.words)[at[: len(run)]]
    starts, codes = np.array(known.starts), np.array(known.codes, dtype=np.int32)
    n = starts[at + 1] - starts[at]
    a = codes[np.repeat(starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
    chunk, done, after = np.repeat(np.arange(len(at)), n), a == _DONE, np.append(a[1:], END)
    # An end of a sentence is one unless a small letter follows.
    keep = ~((a == _MAYBE) & (after >= 0) & ((after >> 1 & 1023) == _SMALL))
    a, chunk, done = np.where(a < 0, END, a)[keep], chunk[keep], done[keep]
    ends = a == END
    owner = np.cumsum(ends) - ends
    hit = np.zeros(int(ends.sum()), bool)
    hit[owner[marks[chunk] & ~ends]] = True
    full = ~ends | ~np.append(True, ends[:-1])[: len(ends)]
    codes_, text = np.where(ends & hit[owner], END_TRUSTED, a).astype(np.int32)[full], (np.cumsum(done) - done)[full]
    return np.split(codes_, np.searchsorted(text, np.arange(1, len(texts)))) if len(texts) else []


class Encoder:
    """Encodes batch after batch, in slices of bounded size; what it remembers is bounded too."""

    def __init__(self) -> None:
        self.known = Chunks()

    def __call__(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        slice_: list[str | None] = []
        size = 0
        for t in texts:
            slice_.append(t)
            size += len(t or "")
            if size > SLICE:
                out, slice_, size = out + self._some(slice_), [], 0
        return out + self._some(slice_)

    def _some(self, texts: list[str | None]) -> list[np.ndarray]:
        if len(self.known.codes) > REMEMBERED:
            self.known = Chunks()
        return encode(texts, self.known)


# Classifier -------------------------------------------------------------------------------------------------------------


#: Buckets of no feature and of a word that comes again at once.
NOTHING, REPEAT = BUCKETS - 2, BUCKETS - 1


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.zeros(len(parts[0]), np.uint32)
    for p in parts:
        h = (h ^ p.astype(np.uint32)) * np.uint32(2654435761)
        h ^= h >> np.uint32(15)
    return (h % np.uint32(BUCKETS // 2 - 2)).astype(np.int32) + np.int32(BUCKETS // 2)


def _before(x: np.ndarray, k: int) -> np.ndarray:
    return np.append(np.zeros(min(k, len(x)), x.dtype), x[:-k])


#: What a shape is: markup, letters, an ideograph.
_MARK, _LETTERS, _SIGN = 1, 2, 4
_KIND = np.zeros(1 << _SHAPE, np.int8)
_KIND[_MARKED] |= _MARK
_KIND[_SAME << 1 : 14 << 1] |= _LETTERS
_KIND[[_IDEOGRAPH << 1, _IDEOGRAPH << 1 | 1]] |= _SIGN | _LETTERS


class Passages:
    """Encoded passages with their features.

    Features are words, pairs and triples of neighbours with the passage's ends, the passage as a whole, and runs of two
    and three shapes around markup. Words that come again at once count as repeats only. ``dense`` holds a bucket for each
    position, ``sparse`` (positions, buckets); the bucket NOTHING is none.
    """

    def __init__(self, texts: Sequence[np.ndarray]) -> None:
        a = np.concatenate([*texts, np.zeros(0, np.int32)]).astype(np.int32, copy=False)
        self.n = len(a)
        end = a < 0
        self.ends = np.flatnonzero(end)
        self.starts = np.append(0, self.ends[:-1] + 1) if len(self.ends) else self.ends
        self.text = np.repeat(np.arange(len(texts)), [len(x) for x in texts])[self.ends]
        self.trusted = a[self.ends] == END_TRUSTED
        self.sizes = self.ends - self.starts + 1
        at = np.arange(len(a), dtype=np.int32) - np.repeat(self.starts, self.sizes).astype(np.int32)
        word, form = a >> _SHAPE, a & ((1 << _SHAPE) - 1)
        word[self.ends], form[self.ends] = _EDGE, 0
        one, two = _before(word, 1), _before(word, 2)
        second = self.starts[self.sizes > 1] + 1
        one[self.starts], two[self.starts], two[second] = _EDGE, _EDGE, _EDGE
        kind = _KIND[form]
        again = ((word == one) | (word == two)) & ((kind & _LETTERS) > 0)
        more = again & _before(again, 1)
        marked = (kind & _MARK) > 0
        pair = _hash(one, word)
        self.dense = [np.where(again | marked | end, NOTHING, word), np.where(more, NOTHING, pair), np.where(more, NOTHING, _hash(two, pair))]
        whole = np.add.reduceat((word + 1).astype(np.uint32) * (at.astype(np.uint32) * np.uint32(2) + np.uint32(0x9E3779B9)), self.starts) if self.n else np.zeros(0, np.uint32)
        near = np.flatnonzero(marked | _before(marked, 1) & (at > 0))
        far = np.flatnonzero(marked | _before(marked, 1) & (at > 0) | _before(marked, 2) & (at > 1))
        f1, f2 = np.where(at[far] < 1, 0, form[far - 1]), np.where(at[far] < 2, 0, form[far - 2])
        g1 = np.where(at[near] < 1, 0, form[near - 1])
        repeats = np.flatnonzero(again & (at < 2 * WINDOW))  # a passage that goes on for ever counts no more than another
        self.sparse = [(near, _hash(g1 + 4096, form[near])), (far, _hash(f2 + 8192, f1, form[far])), (repeats, np.full(len(repeats), REPEAT)), (self.ends, _hash(whole, self.sizes))]
        # The window that ends at each token; a shorter passage is one window.
        width = np.where((kind & _SIGN) > 0, 2 * WINDOW + 4, WINDOW)
        self.window = np.arange(self.n) - np.minimum(at, width - 1)
        self.complete = (at >= width - 1) | end

    def counts(self, p: np.ndarray) -> np.ndarray:
        """Weights by bucket when each passage weighs ``p``."""
        out, used = np.zeros(BUCKETS), p > 1e-3
        weight, used = np.repeat(p, self.sizes), np.repeat(used, self.sizes)
        for bucket in self.dense:
            out += np.bincount(bucket[used], weights=weight[used], minlength=BUCKETS)
        for at, bucket in self.sparse:
            out += np.bincount(bucket, weights=weight[at], minlength=BUCKETS)
        out[NOTHING] = 0
        return out


class Model:
    """Log ratios of the buckets, and the log odds of a passage before it is read."""

    def __init__(self, ratio: np.ndarray, prior: float) -> None:
        self.ratio, self.prior = ratio.astype(np.float32), float(prior)

    def odds(self, ps: Passages) -> np.ndarray:
        """Log odds of passages by their best windows."""
        if not len(ps.ends):
            return np.zeros(0)
        s = sum(self.ratio[bucket] for bucket in ps.dense)
        for at, bucket in ps.sparse:
            s[at] += self.ratio[bucket]
        total = np.append(0, np.cumsum(s, dtype=float))
        windows = np.where(ps.complete, total[1:] - total[ps.window], -np.inf)
        return self.prior + np.maximum.reduceat(windows, ps.starts) / (1 + DEPENDENCE * np.minimum(ps.sizes, WINDOW))


def _chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _codes(batch: pd.Series) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The encoded texts of a batch with their number, in slices of bounded size."""
    out: list[np.ndarray] = []
    size = first = 0
    for i, raw in enumerate(batch):
        out.append(np.frombuffer(raw, np.int32))
        size += len(out[-1])
        if size > CODES:
            yield first, out
            out, size, first = [], 0, i + 1
    yield first, out


def _counted(model: Model | None):
    """The E step, and a partition's share of the M step: (bucket, n, pos); the last bucket counts passages."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, pos = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
        for b in batches:
            for _, codes in _codes(b["codes"]):
                ps = Passages(codes)
                p = np.where(ps.trusted, 1.0, 0.0 if model is None else _chance(model.odds(ps) - HELD_BACK))
                if model is None:
                    n += np.append(ps.counts(np.ones(len(p))), len(p))
                pos += np.append(ps.counts(p), p.sum())
        at = np.flatnonzero(n + pos)
        yield pd.DataFrame({"bucket": at, "n": n[at], "pos": pos[at]})

    return run


def learn(encoded: DataFrame) -> Model:
    """Naive Bayes by expectation-maximization. What comes to the driver in a round is one row for each bucket."""
    model, n = None, np.zeros(0)
    for _ in range(ROUNDS + 1):
        rows = encoded.mapInPandas(_counted(model), "bucket int, n double, pos double").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).toPandas()
        n, pos = np.zeros(BUCKETS + 1) if model is None else n, np.zeros(BUCKETS + 1)
        n[rows["bucket"]] += rows["n"]
        pos[rows["bucket"]] = rows["pos"]
        model = estimate(n, pos)
    return model


def estimate(n: np.ndarray, pos: np.ndarray) -> Model:
    """The model of feature counts: all and those of the positive class."""
    f, g = n[:BUCKETS], pos[:BUCKETS]
    whole, held = max(f.sum(), 1.0), max(g.sum(), 1e-9)
    rest = max(whole - held, 1e-9)
    share = (f + SMOOTHING) / whole
    mixed = lambda x, size: np.log(x + BACKGROUND * held * share + SMOOTHING * size / whole) - np.log(size + BACKGROUND * held)
    ratio = np.where(f > 0, mixed(g, held) - mixed(f - g, rest), 0.0)
    ratio = np.where(ratio > 0, np.maximum(ratio - TELLING, 0), ratio)
    return Model(ratio, np.log((pos[BUCKETS] + 0.5) / (n[BUCKETS] - pos[BUCKETS] + 0.5)))


def encoded(texts: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, codes): the texts as tokens, written once. Null, empty and blank texts have none."""
    known: list[Encoder] = []

    def run(s: pd.Series) -> pd.Series:
        if not known:
            known.append(Encoder())
        return pd.Series([c.tobytes() for c in known[0](list(s.where(s.notna(), None)))], dtype=object)

    return cut(texts.select(F.col(key), F.pandas_udf(lambda s: run(s), "binary")(column).alias("codes")))


def score(coded: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, n_passages, n_residue, odds, passage_no): each record with its likeliest passage, counted from 1."""

    def run(batch: pd.Series) -> pd.DataFrame:
        out = []
        for _, codes in _codes(batch):
            ps = Passages(codes)
            odds, at = model.odds(ps), np.searchsorted(ps.text, np.arange(len(codes) + 1))
            for i, j in zip(at[:-1], at[1:]):
                o = odds[i:j]
                best = int(o.argmax()) if len(o) else None
                out.append((j - i, int((o >= LEAST).sum()), None if best is None else float(o[best]), None if best is None else best + 1))
        return pd.DataFrame(out, columns=["n_passages", "n_residue", "odds", "passage_no"]).astype({"passage_no": object})

    kind = "n_passages int, n_residue int, odds double, passage_no int"
    return coded.select(F.col(key), F.pandas_udf(lambda s: run(s), kind)("codes").alias("s")).select(key, "s.*")


def detect(texts: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Every record with its number of residue passages, from a model learnt on all of them.

    Null, empty and blank texts have no passages and are no residue; repeated rows are scored alike.
    """
    coded = encoded(texts, key, column)
    return score(coded, learn(coded), key)
