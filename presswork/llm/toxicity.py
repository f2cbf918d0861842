"""Toxicity by noisy-channel deobfuscation.

A token is read as a noisy rendering of a word: signs may stand for letters (leetspeak),
letters may be repeated, dots or dashes put between them, and a word may be spelled out
over tokens of one sign each. The lattice of readings is decoded by Viterbi under a
character trigram model of the training words, where every substitution and every
collapsed repetition costs a fixed channel penalty. White space within a run of tokens of
one sign each (THREE or more) is a sign of the channel too: it ends a word or is left out,
each at a price, and Viterbi chooses. So are the gaps of longer fragments where some
reading of neighbouring tokens makes up a whole word that has a ratio. Restored words are then scored: each
distinct word brings the largest log-likelihood ratio among its own and its beginnings'
(PREFIXES letters), a document's evidence is the sum of its EVIDENCE largest ratios, and a logistic
function fitted on the training rows turns it into a score. All words of the whole text are looked at;
a sum of all ratios would grow with a clean text's length by words that speak weakly.

Words of letters alone without a letter twice running are a lattice of one path and
stand for themselves. Signs at the ends of a token may be letters or be left out; a token
is scored by the best reading with and the best without the latter, and by itself if it
has letters only. Digits alone may also be a number, at NUMBER a digit.

A token is decoded only if some reading of it could have a ratio. That is decided exactly,
on canonical forms: letters that share a sign are one letter, signs become letters, what
can't be read goes, and runs become one sign. All readings of a token have its canonical
form, so a token whose form begins no ratio's form and is none can't score. Broken-up words
are found in the same way, by an Aho-Corasick scan of a text's canonical forms for those of
whole words, and then decoded. There a `*` only stands between letters.

The character model, the ratios and the logistic function are fitted on all labelled rows
that are not held out, each counted once; all trigrams, words and ratios of them are kept,
whatever their length. Texts are met with labels by a shuffle; counts are added up by task and
then by key, and each Newton step of the logistic function is a sum over the rows' evidence.
The query takes that from the pass that reads all rows, which is written once. What the driver
gets and broadcasts is the trigrams and the parts of words that can have a ratio: it grows with the
vocabulary of toxic texts, not with their number. Scores read whole texts of all rows.

Defined cases: null and empty texts have no evidence and score what the fit gives for
none; without labels everything scores the prior 0; null labels teach nothing; a doc_id
that repeats teaches with its smallest text and label; repeated rows score alike; an empty table gives an empty result; other columns are ignored. A
null doc_id is not held out.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate, chain, product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.llm.base import remainder, small_batches
from presswork.plans.lineage import cut

PREFIXES, EVIDENCE = (4, 5, 6, 7, 8), 5
#: Natural log penalties of the channel.
SWAP, REPEAT, SKIP = -1.5, -0.7, -0.7
NUMBER = -math.log(10)
#: Doubled letters of a word up to which all its spellings are kept, 2 ** DOUBLED at most; words with
#: more are looked for by a pattern each.
DOUBLED = 4
#: A gap within spelled-out words and within fragments: left out, ending a word.
GAPS = {True: (math.log(0.8), math.log(0.2)), False: (-1.5, 0.0)}
#: One-sign tokens that make a run.
THREE = 3
#: Words kept in a worker's memory of what they scored.
REMEMBERED = 1_000_000
#: Words and parts of words that a task counts before it hands counts on.
COUNTED = 400_000

#: Signs and the letters they are commonly written for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou"}
#: Signs that may stand between the letters of a word.
BETWEEN = ".-_*~'`,"

_EDGE = re.compile(r"^[^\w@$!|+(€*]+|[^\w@$|+€*]+$")
#: Signs that stand for letters or are left out at the ends of a token, and what is neither.
_SIGNS = "@$!|+(€*"
_OUTER = re.compile(r"^[^\w@$!|+(€*]+|[^\w@$!|+(€*]+$")
_NUMBER = re.compile(r"[@$!|+(€*]?\d[\d.,:/-]*[@$!|+(€*]?")
_RUN = re.compile(r"(.)\1")


class CharModel:
    """Trigram log probabilities of the characters of words, with interpolated lower
    orders; words are framed by two starts and an end."""

    def __init__(self, counts: dict[str, int]):
        self.three, two, one = counts, Counter(), Counter()
        context, self.seen = Counter(), 0
        for gram, n in counts.items():
            two[gram[1:]] += n
            one[gram[2]] += n
            context[gram[:2]] += n
            self.seen += n
        self.two, self.one, self.context = two, one, context
        self.middle = Counter()
        for gram, n in two.items():
            self.middle[gram[0]] += n
        self.memo: dict[tuple[str, str, str], float] = {}
        self.doubles: dict[tuple[str, str, str, bool], bool] = {}

    def logp(self, a: str, b: str, c: str) -> float:
        key = (a, b, c)
        if key not in self.memo:
            p = (self.one[c] + 0.1) / (self.seen + 10)
            p = (self.two[b + c] + 4 * p) / (self.middle[b] + 4)
            p = (self.three.get(a + b + c, 0) + 4 * p) / (self.context[a + b] + 4)
            self.memo[key] = math.log(p)
        return self.memo[key]

    def doubled(self, before: str, letter: str, after: str, more: bool) -> bool:
        """Is a run of a letter, of two or more, likelier read as two than as one?"""
        key = (before, letter, after, more)
        if key not in self.doubles:
            one = REPEAT + self.logp(before, letter, after)
            self.doubles[key] = (REPEAT if more else 0.0) + self.logp(before, letter, letter) + self.logp(letter, letter, after) > one
        return self.doubles[key]

    def undoubled(self, word: str) -> str:
        """decode() for letters alone. Both readings of a run end in its letter, and with the
        sign after it their last two characters are the same, so each run is decided by itself."""
        return _REPEATS.sub(lambda m: m[1] * (1 + self.doubled(word[m.start() - 1] if m.start() else "^", m[1], word[m.end()] if m.end() < len(word) else "$", len(m[0]) > 2)), word)

    def decode(self, token: str, ends: bool = True) -> str:
        """The likeliest reading of a token, in time linear in its length; signs at its ends
        can be left out if `ends`."""
        return self.undoubled(token) if token.isalpha() else self.lattice(token, ends)

    def lattice(self, token: str, ends: bool) -> str:
        runs = [(m[0], m[0][0]) for m in re.finditer(r"(.)\1*", token, re.S)]
        first = len(token) - len(token.lstrip(_SIGNS)) if ends else 0
        last_ = len(token.rstrip(_SIGNS)) if ends else len(token)
        # state: the last two characters; value: log probability and the way back to what was read
        states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
        at = 0
        for whole, sign in runs:
            readings: list[tuple[str, float]] = []
            letters = [sign] if sign.isalpha() else []
            swaps = list(LEET.get(sign, ""))
            n = len(whole)
            for letter, price in [(x, 0.0) for x in letters] + [(x, SWAP) for x in swaps]:
                readings.append((letter, price + (REPEAT if n > 1 else 0.0)))
                if n > 1:
                    readings.append((letter * 2, price * 2 + (REPEAT if n > 2 else 0.0)))
            if sign in BETWEEN or not readings:
                readings.append(("", SKIP))
            elif at < first or at >= last_:
                readings.append(("", SKIP * n))
            at += n
            following: dict[str, tuple[float, tuple | None]] = {}
            for last, (value, back) in states.items():
                for read, price in readings:
                    a, b, v = last[0], last[1], value + price
                    for c in read:
                        v += self.logp(a, b, c)
                        a, b = b, c
                    if a + b not in following or v > following[a + b][0]:
                        following[a + b] = (v, (back, read) if read else back)
            states = following
        if len(states) > 1:
            states.pop("^^", None)  # a token is not all left out if it can be read
        best, _, back = max(((v + self.logp(k[0], k[1], "$"), k, back) for k, (v, back) in states.items()), key=lambda x: x[:2])
        if _NUMBER.fullmatch(token) and NUMBER * sum(map(str.isdigit, token)) > best:
            return token.strip(_SIGNS)
        out: list[str] = []
        while back:
            back, read = back
            out.append(read)
        return "".join(reversed(out))


    def spaced(self, signs: list[str], spelled: bool = True) -> list[str]:
        """The likeliest words of neighbouring tokens whose gaps may be none."""
        join, stop = GAPS[spelled]
        states: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
        for at, token in enumerate(signs):
            if at:
                following = {k: (v + join, back) for k, (v, back) in states.items()}
                v, back = max(((v + stop + self.logp(k[0], k[1], "$"), back) for k, (v, back) in states.items() if k != "^^"), key=lambda x: x[0], default=(-math.inf, None))
                if v > following.get("^^", (-math.inf,))[0]:
                    following["^^"] = (v, (back, " "))
                states = following
            for m in re.finditer(r"(.)\1*", token, re.S):
                sign, n = m[1], len(m[0])
                options = [(x * k, price * k + (REPEAT if n > k else 0.0)) for x, price in _options(sign) for k in range(1, min(n, 2) + 1)]
                if sign in BETWEEN or not options or (sign in "!(|" and at + 1 == len(signs)):
                    options.append(("", SKIP))
                following = {}
                for last, (value, back) in states.items():
                    for read, price in options:
                        x, y, v = last[0], last[1], value + price
                        for c in read:
                            v += self.logp(x, y, c)
                            x, y = y, c
                        if x + y not in following or v > following[x + y][0]:
                            following[x + y] = (v, (back, read) if read else back)
                states = following
        _, _, back = max(((v + (self.logp(k[0], k[1], "$") if k != "^^" else 0.0), k, back) for k, (v, back) in states.items()), key=lambda x: x[:2])
        out: list[str] = []
        while back:
            back, read = back
            out.append(read)
        return "".join(reversed(out)).split()


def _options(sign: str) -> list[tuple[str, float]]:
    """Letters that a sign may stand for, with their prices."""
    return [(x, 0.0) for x in sign if x.isalpha()] + [(x, SWAP) for x in LEET.get(sign, "")]


def restore(token: str, model: CharModel | None) -> str:
    """The word that a lower-case token stands for."""
    core = _OUTER.sub("", token)
    if not core or (core.isalpha() and not _RUN.search(core)):
        return core
    return core.strip(_SIGNS) if model is None else model.decode(core)


def readings(token: str, model: CharModel) -> set[str]:
    """The words by which a lower-case token is scored: what it is restored to with signs at
    its ends left out or read, and its own letters."""
    core = _OUTER.sub("", token)
    found = {restore(core, model)}
    if core and (core[0] in _SIGNS or core[-1] in _SIGNS):
        found.add(model.decode(core, False))
        core = core.strip(_SIGNS)
    if core.isalpha():
        found.add(core)
    return found


def one_sign(token: str) -> bool:
    """Is it a token of one sign, repeated or with punctuation after it?"""
    core = _EDGE.sub("", token) or token
    return core == core[0] * len(core)


def spelled(found: list[str], ones: set[str]) -> list[list[str]]:
    """The runs of THREE tokens or more that are all in ones."""
    out: list[list[str]] = []
    before = -2
    for i in [i for i, t in enumerate(found) if t in ones]:
        if i != before + 1:
            out.append([])
        out[-1].append(_EDGE.sub("", found[i]) or found[i])
        before = i
    return [run for run in out if len(run) >= THREE]


def spelled_words(found: list[str], model: CharModel) -> set[str]:
    """The words that are spelled out in a text's tokens."""
    return {w for run in spelled(found, {t for t in set(found) if one_sign(t)}) for w in model.spaced(run)}


def parts(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in PREFIXES if len(word) > n)] if len(word) >= 3 else []


#: Every sign's letter, with letters that share a sign as one.
_FORM = str.maketrans({sign: letters[0] for sign, letters in LEET.items() if sign != "*"} | {"l": "i"})
_REPEATS = re.compile(r"(.)\1+", re.S)


def letters(core: str) -> str:
    """The letters that signs may stand for, runs left as they are."""
    plain = core.translate(_FORM)
    return plain if plain.isalpha() else "".join(filter(str.isalpha, plain))


def form(core: str) -> str:
    """The canonical form that all readings of core share (but for a `*` read as a vowel)."""
    return _REPEATS.sub(r"\1", letters(core))


def grams(texts: list[str]) -> Counter:
    """Character trigrams of the distinct plain words of texts."""
    words: Counter = Counter()
    for text in texts:
        words.update(set(text.lower().split()))
    return trigrams(words)


def trigrams(words: Counter) -> Counter:
    """Character trigrams of the plain ones among tokens, each as often as it is counted."""
    cores = [(w, n) for token, n in words.items() if (w := token if token.isalpha() else _EDGE.sub("", token)).isalpha()]
    signs = np.frombuffer("".join([f"^^{w}$" for w, _ in cores]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    inside = (signs[:-2] != ord("$")) & (signs[1:-1] != ord("$"))  # else it begins in one word and ends in the next
    often = np.repeat([n for _, n in cores], [len(w) + 3 for w, _ in cores])[:-2]
    found, of = np.unique((signs[:-2] << 42 | signs[1:-1] << 21 | signs[2:])[inside], return_inverse=True)
    sums = np.bincount(of, often[inside], len(found))  # exact below 2 ** 53
    return Counter({chr(g >> 42) + chr(g >> 21 & 0x1FFFFF) + chr(g & 0x1FFFFF): int(n) for g, n in zip(found.tolist(), sums.tolist(), strict=True)})


class Parts:
    """The parts of words that tokens are read as, numbered, and in how many texts they are."""

    def __init__(self, model: CharModel):
        self.model = model
        self.numbers: dict[str, int] = {}
        self.tokens: dict[str, int] = {}
        self.ones: set[str] = set()
        self.flat, self.ends = array("q"), array("q", [0])

    def of(self, words: set[str]) -> list[int]:
        every = {p for w in words for p in parts(w)} if len(words) > 1 else parts(*words)
        return [self.numbers.setdefault(p, len(self.numbers)) for p in every]

    def note(self, token: str) -> None:
        plain = token.isalpha()
        core = token if plain else _OUTER.sub("", token)
        self.tokens[token] = len(self.tokens)
        self.flat.extend(self.of({core, self.model.undoubled(core)} if core.isalpha() else readings(token, self.model)))
        self.ends.append(len(self.flat))
        if not (plain and token[0] != token[-1]) and one_sign(token):
            self.ones.add(token)

    def add(self, texts: list[str], labels: list[int], sums: np.ndarray) -> np.ndarray:
        """sums (a row a label, a column a part), with each part of each text added once."""
        codes, spelt = [], []
        for text in texts:
            every = text.lower().split()
            found = set(every)
            for token in found.difference(self.tokens):
                self.note(token)
            codes.append(np.fromiter(map(self.tokens.__getitem__, found), np.int64, len(found)))
            words = set() if self.ones.isdisjoint(found) else {w for run in spelled(every, self.ones) for w in self.model.spaced(run)}
            spelt.append(self.of(words) if words else [])
        sums = np.pad(sums, ((0, 0), (0, len(self.numbers) - sums.shape[1])))
        flat, ends = np.array(self.flat, np.int64), np.array(self.ends, np.int64)
        for code, more, label in zip(codes, spelt, labels, strict=True):
            start, size = ends[code], ends[code + 1] - ends[code]
            at = np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)
            ids = np.concatenate([flat[at], np.array(more, np.int64)])
            sums[label, ids] += 1  # a number that is there twice counts once
        return sums


def _kept(shared, build: Callable):
    """What a worker makes of a broadcast (digest, value) and keeps from one task to the next."""
    digest, value = shared.value
    if _held.get("digest") != digest:
        _held.clear()
        _held.update(digest=digest, made=build(value))
    return _held["made"]


_held: dict = {}


def _shared(spark: SparkSession, model: dict):
    return spark.sparkContext.broadcast((hashlib.sha256(pickle.dumps(model)).hexdigest(), model))


class Scorer:
    """Evidence of texts under a fitted model."""

    def __init__(self, model: dict):
        self.model = CharModel(model["grams"])
        self.ratio = model.get("ratio", {})
        self.weights = model.get("weights")
        self.forms: dict[str, str] = {}
        self.hot: dict[str, float] = {}
        self.whole = {p[:-1] for p in self.ratio if p.endswith("$")}
        self.whole_forms = {form(w) for w in self.whole}
        self.part_forms = {form(p) for p in self.ratio if not p.endswith("$")}
        self.sizes = sorted({len(f) for f in self.part_forms})
        every = self.whole_forms | self.part_forms
        self.begun = {f[:n] for f in every for n in range(len(f) + 1)}
        # the first four letters of all forms, and the forms that are shorter
        self.heads, self.short = {f[:4] for f in every}, {f for f in every if len(f) < 4}
        self.finder = ahocorasick.Automaton()
        self.long: list[re.Pattern] = []
        for word in self.whole:
            # a doubled letter may fall on a gap, where it stays doubled
            runs = [(m[1], len(m[0])) for m in re.finditer(r"(.)\1*", letters(word), re.S)]
            if sum(n > 1 for _, n in runs) > DOUBLED:
                self.long += [self._optional(runs, first, last) for first in range(1, 3) for last in range(1, 3) if first <= runs[0][1] and last <= runs[-1][1]]
                continue
            for spelled_as in product(*[(c, c * 2) if n > 1 else (c,) for c, n in runs]):
                if len(key := "".join(spelled_as)) > 1:
                    self.finder.add_word(key, len(key))
        if len(self.finder):
            self.finder.make_automaton()
        self.joined: dict[tuple[str, ...], frozenset[str]] = {}

    @staticmethod
    def _optional(runs: list[tuple[str, int]], first: int, last: int) -> re.Pattern:
        """A pattern of these runs, of which the inner ones of two letters or more are one or two,
        the outer ones as long as told; it matches where they begin."""
        inner = "".join(re.escape(c) + ("{1,2}" if n > 1 else "") for c, n in runs[1:-1])
        return re.compile(f"(?=({re.escape(runs[0][0]) * first}{inner}{re.escape(runs[-1][0]) * last}))", re.S)

    def spelled_out(self, stream: str) -> Iterator[tuple[int, int]]:
        """(last sign, length) of each place of a whole word's form in a stream of signs."""
        found = self.finder.iter(stream) if len(self.finder) else iter(())
        if not self.long:
            return found
        return chain(found, ((m.end(1) - 1, m.end(1) - m.start()) for pattern in self.long for m in pattern.finditer(stream)))

    def possible(self, token: str) -> bool:
        """Could some reading of the token have a ratio?"""
        core = _OUTER.sub("", token)
        left, right = core.lstrip(_SIGNS), core.rstrip(_SIGNS)
        if len(set(core[: len(core) - len(left)])) > 1 or len(set(core[len(right) :])) > 1 or core[:1] == "*":
            return True  # signs at an end may be read or left out one by one
        star = core.find("*")
        if star >= 0:
            heads = {form(core[:star]), form(left[: max(0, left.find("*"))])}
            return any(f in self.begun or any(f[:n] in self.part_forms for n in self.sizes) for f in heads)
        return any(self.known(form(part)) for part in {core, left, right, core.strip(_SIGNS)})

    def known(self, f: str) -> bool:
        """Does some ratio's form begin f, or is some whole word's form f?"""
        if f[:4] not in self.heads and f[:3] not in self.short and f[:2] not in self.short and f[:1] not in self.short:
            return False
        if f in self.whole_forms:
            return True
        for n in self.sizes:
            if f[:n] in self.part_forms:
                return True
        return False

    def note(self, token: str) -> None:
        """Remember a token's form, and its ratio if it has one."""
        core = token if token.isalpha() else _OUTER.sub("", token)
        if core.isalpha():
            f = _REPEATS.sub(r"\1", core.translate(_FORM))
            possible = self.known(f)
        else:
            f = form(_EDGE.sub("", token))
            possible = self.possible(token)
        self.forms[token] = f
        if possible and (value := self.word(token)):
            self.hot[token] = value

    def note_all(self, tokens: set[str]) -> None:
        """The same for many tokens."""
        plain = [t for t in tokens if t.isalpha()]
        forms = _REPEATS.sub(r"\1", "\n".join(plain).translate(_FORM)).split("\n") if plain else []
        for token, f in zip(plain, forms, strict=True):
            self.forms[token] = token if f == token else f
            if self.known(f) and (value := self.word(token)):
                self.hot[token] = value
        for token in tokens.difference(plain):
            self.note(token)

    def fragments(self, every: list[str], forms: list[str]) -> set[str]:
        """Words with a ratio that neighbouring tokens make up by the likeliest reading."""
        out: set[str] = set()
        stream = "".join(forms)
        ends = None
        for last, size in self.spelled_out(stream):
            if ends is None:
                ends = [0, *accumulate(map(len, forms))]
                edge = set(ends)
            if last + 1 in edge and last + 1 - size in edge:
                i, j = bisect_right(ends, last + 1 - size) - 1, bisect_left(ends, last + 1)
                if j - i > 1:
                    run = tuple(_EDGE.sub("", t) or t for t in every[i:j])
                    found = self.joined.get(run)
                    if found is None:
                        if len(self.joined) >= REMEMBERED:
                            self.joined.clear()
                        found = self.joined[run] = frozenset(w for w in self.model.spaced(list(run), False) if w in self.whole)
                    out |= found
        return out

    def word(self, token: str) -> float:
        """The largest ratio of the token's readings."""
        ratio = self.ratio
        if not self.possible(token):
            return 0.0
        return max((ratio[p] for w in readings(token, self.model) for p in parts(w) if p in ratio), default=0.0)

    def evidence(self, text: str) -> list[float]:
        """The EVIDENCE largest ratios' sum, the largest, the second, and log of how many
        distinct tokens there are."""
        every = text.lower().split()
        words = set(every)
        if len(self.forms) > REMEMBERED:
            self.forms.clear()
            self.hot.clear()
        self.note_all(words.difference(self.forms))
        forms = list(map(self.forms.__getitem__, every))
        # a token of one sign has a form of one letter or none
        ones = {t for t, f in zip(every, forms, strict=True) if len(f) < 2 and one_sign(t)}
        joined = {w for run in spelled(every, ones) for w in self.model.spaced(run)} if ones else set()
        joined |= self.fragments(every, forms)
        found = [self.hot[t] for t in words & self.hot.keys()] + [max((self.ratio[p] for p in parts(w) if p in self.ratio), default=0.0) for w in joined - words]
        found = sorted(filter(None, found), reverse=True)
        return [sum(found[:EVIDENCE]), found[0] if found else 0.0, found[1] if len(found) > 1 else 0.0, math.log1p(len(words))]

    def score(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        x = np.array([[1.0, *self.evidence(t)] for t in texts]).reshape(len(texts), 5)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def logistic(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], size: int, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic function (first column: 1), by Newton steps; sums: the negative
    second derivative and the gradient of the log likelihood at given weights."""
    w = np.zeros(size)
    penalty = np.eye(size) * ridge
    penalty[0, 0] = 1e-3
    for _ in range(30):
        second, first = sums(w)
        step = np.linalg.solve(second + penalty, first - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def derivatives(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    return (x * (p * (1 - p))[:, None]).T @ x, x.T @ (y - p)


def ratios(counts: list[tuple[str, int, int]], toxic: int, clean: int, least: int = 3, floor: float = 1.0) -> dict[str, float]:
    """Log-likelihood ratio of each part of words that is in `least` toxic texts or more
    and speaks for them by `floor` or more."""
    out = {}
    for part, a, b in counts:
        if a >= least:
            r = math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5 + 0.02 * a) / (clean + 1))
            if r >= floor:
                out[part] = r
    return out


def taught(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> DataFrame:
    """(doc_id, text, label, mark): all labelled rows that are not held out, an id once; mark: a
    hash of the text."""
    known = labels.select("doc_id", F.col(column).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    known = known.where(remainder(F.col("doc_id"), 3) != 1).groupBy("doc_id").agg(F.min("label").alias("label"))
    texts = docs.where("doc_id is not null").where(remainder(F.col("doc_id"), 3) != 1).select("doc_id", _text())
    rows = texts.join(known, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    return cut(rows.withColumn("mark", F.xxhash64("text")))


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")


def learn(few: DataFrame) -> dict:
    """Trigrams and ratios of few(text, label)."""
    spark = few.sparkSession
    sizes = {r["label"]: r["count"] for r in few.groupBy("label").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return {"grams": {}}

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def out() -> pa.RecordBatch:
            found = trigrams(words)
            return pa.record_batch([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["gram", "n"])

        for _, texts in small_batches(batches):
            for text in texts:
                words.update(set(text.lower().split()))
            if len(words) > COUNTED:
                yield out()
                words.clear()
        yield out()

    counted = few.select("text").mapInArrow(count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    model: dict = {"grams": {r["gram"]: r["n"] for r in counted.collect()}}
    shared = _shared(spark, model)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Parts = _kept(shared, lambda value: Parts(CharModel(value["grams"])))
        numbers, sums = held.numbers, np.zeros((2, 0), np.int64)

        def out() -> pa.RecordBatch:
            some = np.flatnonzero(sums.any(axis=0))
            names = list(numbers)
            return pa.record_batch([pa.array([names[i] for i in some.tolist()], pa.string()), pa.array(sums[1, some]), pa.array(sums[0, some])], names=["part", "a", "b"])

        for part, texts in small_batches(batches):
            if len(held.tokens) > REMEMBERED:
                yield out()
                held.__init__(held.model)
                numbers, sums = held.numbers, np.zeros((2, 0), np.int64)
            sums = held.add(texts, part.column(1).to_pylist(), sums)
        yield out()

    strong = few.select("text", "label").mapInArrow(emit, "part string, a long, b long").repartition("part").groupBy("part").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where("a >= 3")
    strong = strong.where((F.col("a") + 0.5) / (toxic + 1) > 2 * (F.col("b") + 0.5) / (clean + 1))
    model["ratio"] = ratios([(r["part"], r["a"], r["b"]) for r in strong.collect()], toxic, clean)
    return model


def evidence(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, mark (a hash of the text) and x, the evidence, for each row of docs."""
    shared = _shared(docs.sparkSession, {k: v for k, v in model.items() if k != "weights"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer: Scorer = _kept(shared, Scorer)
        for part, texts in small_batches(batches):
            yield pa.record_batch([*part.columns[1:], pa.array([scorer.evidence(t) for t in texts], pa.list_(pa.float64()))], names=["doc_id", "held_out", "mark", "x"])

    rows = docs.select(_text(), "doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out")).withColumn("mark", F.xxhash64("text"))
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, mark long, x array<double>")


def fit(found: DataFrame, few: DataFrame) -> np.ndarray:
    """Weights of the logistic function, from the evidence of the rows in few."""
    known = few.select(F.col("doc_id").alias("id"), F.col("mark").alias("of"), "label")
    rows = cut(found.join(known, (F.col("doc_id") == F.col("id")) & (F.col("mark") == F.col("of"))).dropDuplicates(["id"]).select("label", "x"))

    def sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = len(w)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = np.column_stack([np.ones(len(batch)), batch.column(1).flatten().to_numpy().reshape(len(batch), size - 1)])
                second, first = derivatives(x, batch.column(0).to_numpy().astype(float), w)
                yield pa.record_batch([pa.array([v]) for v in (*second.ravel(), *first)], names=names)

        names = [f"s{i}" for i in range(size * (size + 1))]
        total = np.array(rows.mapInArrow(run, ", ".join(f"{n} double" for n in names)).agg(*[F.sum(n) for n in names]).first(), float)
        return total[: size * size].reshape(size, size), total[size * size :]

    return logistic(sums, 5)


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> dict:
    """The model fitted on all labelled rows that are not held out."""
    few = taught(docs, labels, column)
    model = learn(few)
    if "ratio" in model:
        model["weights"] = fit(evidence(few, model), few)
    return model


def _scored(found: DataFrame, weights: np.ndarray | None, threshold: float) -> DataFrame:
    value = F.lit(0.0)
    if weights is not None:
        total = F.lit(float(weights[0]))
        for i, w in enumerate(weights[1:].tolist()):
            total = total + F.lit(w) * F.col("x")[i]
        value = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))
    rows = found.select("doc_id", "held_out", value.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score(docs: DataFrame, model: dict, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    return _scored(evidence(docs, model), model.get("weights"), threshold)


def scores(docs: DataFrame, labels: DataFrame, column: str = "toxic", threshold: float = 0.7) -> DataFrame:
    """Train and score all rows of docs, each read for its evidence once."""
    few = taught(docs, labels, column)
    model = learn(few)
    if "ratio" not in model:
        return score(docs, model, threshold)
    found = cut(evidence(docs, model))
    return _scored(found, fit(found.where("not held_out"), few), threshold)
