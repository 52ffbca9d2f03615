"""Toxicity by noisy-channel deobfuscation under a character language model."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import learns, sampled, table, written

FIT_ROWS = 12_000
"""The classifier is fitted on so many labelled documents at most, those with the smallest id hashes."""
FEATURES = 4_096
"""Word beginnings and words the classifier may weigh."""
LEAST_DOCS = 4
"""Toxic documents of the sample that must hold a feature."""
SHORTEST, LONGEST = 3, 9
"""Lengths of the word beginnings that are features, besides whole words."""
THINNED = 4
"""Copies of each toxic document with a random one in so many of its words: a single toxic word has to suffice."""
PENALTY = 2.0
"""Residual documents a word beginning must explain before it weighs anything."""
MEMORY = 200_000
"""Restored words a task remembers."""
LONG_KEY = 64
"""Longer stretches between letter pairs are searched each time instead of remembered."""
CHUNK = 1 << 20
"""Characters a task counts at a time."""

# What may stand for which letters, and what it costs in nats to read it so.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
ALIKE = {"а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ѕ": "s", "ο": "o", "α": "a", "ι": "i"}
CYRILLIC_LEET = {"3": "з", "4": "ч", "6": "б"}
READ, DROP_INSIDE, DROP_AT_EDGE, DROP_REPEAT, DROP_SPACE = 1.0, 8.0, 1.0, 0.7, 1.0

# Symbols of the model: 0-59 and from 64 on letters; word ends, all that is no letter, and letters too rare for a symbol of their own.
SYMBOLS = 64
END, OTHER, RARE = 60, 61, 62
MOST_SYMBOLS = 192
"""Letters beyond so many symbols, the rarest ones, share ``RARE`` in the counts; each is still read as itself."""
_LATIN = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
# places in Unicode that no text gives a meaning: letters of a token that can be read in one way only, and those that can't
_TWINS, _LATIN_TWINS = 0x10F000, 0x10F800

_START, _STOP, _NONE = np.array([END, END]), np.array([END]), np.empty(0, np.int64)

_PUNCTUATION = ".,;:?\"'-)"
_TWICE, _THRICE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")
_EDGE = re.compile(r"^[^\w$@!|+(€£¡]+|[^\w$@!|+(€£¡]+$")
_RUN_AT_EDGE = re.compile(r"^([^\w\s])\1+|([^\w\s])\2+$")
_REPEATS = re.compile(r"(.)\1+")


class Alphabet:
    """The letters of a corpus, each one's symbol, and what every character may be read as.

    a-z and the lower-case letters of Latin-1 always have symbols; ``more`` are
    the corpus' other letters, the most frequent first. A letter that looks
    like a Latin one may be read as either; but in a token with a letter that
    looks like none, it is itself, and a Latin letter there may stand for it.
    Such tokens are written with twins of these letters (``own``, ``back``).
    """

    def __init__(self, more: str = ""):
        self.more = more
        symbol = {c: k for k, c in enumerate(_LATIN)}
        for c in more:
            k = len(symbol) if len(symbol) < END else len(symbol) + SYMBOLS - END
            symbol[c] = k if k < MOST_SYMBOLS else RARE
        self.symbols = max(SYMBOLS, max(symbol.values()) + 1)
        self.codes = np.full(0x110000 if more else 256, OTHER, np.uint8)
        self.codes[[ord(c) for c in symbol]] = list(symbol.values())
        self.codes[[9, 10, 11, 12, 13, 32]] = END
        twins = {c: chr(_TWINS + k) for k, c in enumerate(ALIKE) if c in symbol}
        latin: dict[str, list[str]] = {}
        for c in twins:
            latin.setdefault(ALIKE[c], []).append(c)
        self.twins = str.maketrans(twins | {x: chr(_LATIN_TWINS + ord(x)) for x in latin})
        self.back = {ord(t): c for c, t in twins.items()} | {_LATIN_TWINS + ord(x): x for x in latin}
        self.index = {c: k for c, k in symbol.items() if c not in ALIKE} | {twins[c]: symbol[c] for c in twins}
        # all that isn't itself only: what it may be read as, and the cost
        self.readings = {c: [(x, READ) for x in letters] for c, letters in LEET.items()}
        for c, x in ALIKE.items():
            self.readings[c] = [(x, READ)] + ([(twins[c], 0.0)] if c in twins else [])
        for found in self.readings.values():
            found += [(twins[c], READ) for x, _ in list(found[: len(found)]) for c in latin.get(x, ()) if (twins[c], 0.0) not in found]
        for c, x in CYRILLIC_LEET.items():
            self.readings[c] += [(x, READ)] if x in symbol else []
        for x, letters in latin.items():
            self.readings[chr(_LATIN_TWINS + ord(x))] = [(x, 0.0)] + [(twins[c], READ) for c in letters]
        self.solid = {chr(_LATIN_TWINS + ord(x)) for x in latin}
        only = "".join(map(re.escape, self.index))
        self.plain = re.compile(f"[{only}]+")
        # two different letters side by side: behind them the lattice has one state, whatever came before
        self.pair = re.compile(f"([{only}])(?!\\1)[{only}]")
        foreign = "".join(re.escape(c) for c in more if c not in ALIKE)
        self.foreign = re.compile(f"[{foreign}]") if foreign else None

    def __reduce__(self):
        return Alphabet, (self.more,)

    def own(self, token: str) -> str:
        """A token with a letter that looks like no Latin one, in letters of one reading where they have one."""
        return token.translate(self.twins) if self.foreign and not token.isascii() and self.foreign.search(token) else token

    def shown(self, word: str) -> str:
        """The letters that twins stand for."""
        return word.translate(self.back) if self.back and not word.isascii() else word

    def pair_code(self, two: str) -> int:
        """The symbols of two letters as one number, -1 if they aren't two letters."""
        return self.index[two[0]] * self.symbols + self.index[two[1]] if len(two) == 2 and two[0] in self.index and two[1] in self.index else -1


LATIN = Alphabet()


def bare(token: str) -> str:
    """A token without the signs at its edges that are read as nothing; letters and digits there are never signs."""
    if token and token[0].isalnum() and token[-1].isalnum():
        return token
    return _EDGE.sub("", _RUN_AT_EDGE.sub("", token))


def is_letter(c: str) -> bool:
    """Letters, and vowel signs and the like that words of some scripts are written with; not accents put on other letters."""
    kind = unicodedata.category(c)
    return kind[0] == "L" or kind in ("Mn", "Mc") and not unicodedata.name(c, "").startswith(("COMBINING", "VARIATION"))


def corpus_alphabet(docs: DataFrame) -> Alphabet:
    """The alphabet of all texts; what reaches the driver is a row per letter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                lower = text.as_py().lower()
                for at in range(0, len(lower), CHUNK):
                    code = np.frombuffer(lower[at : at + CHUNK].encode("utf-32-le", "replace"), np.uint32)
                    seen, n = np.unique(code[code > 0xFF], return_counts=True)
                    total[seen] += n
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["code", "n"])

    wider = docs.select("text").where(F.col("text").rlike(r"[^\x00-\xFF]"))
    counted = wider.mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    found = sorted((-r["n"], chr(r["code"])) for r in counted)
    return Alphabet("".join(c for _, c in found if is_letter(c)))


def trigram_counts(docs: DataFrame, alphabet: Alphabet = LATIN) -> DataFrame:
    """``trigram, n`` over every character of all texts: at most as many rows as symbols cubed, combined in each task first."""
    symbols = alphabet.symbols

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(symbols**3, np.int64), [], 0

        def add() -> None:
            c = np.concatenate(held) if held else np.empty(0, np.int64)
            if len(c) > 2:
                total[:] += np.bincount((c[:-2] * symbols + c[1:-1]) * symbols + c[2:], minlength=symbols**3)

        for batch in batches:
            for text in batch.column("text"):
                lower = (text.as_py() or "").lower()
                for at in range(0, len(lower), CHUNK):  # a long text is counted in pieces that overlap by two characters
                    if size > CHUNK:
                        add()
                        # the next piece of the same text goes on from the last two symbols
                        held, size = ([held[-1][-2:]] if at else []), 0
                    held.append(_codes(lower[at : at + CHUNK], at == 0, at + CHUNK >= len(lower), held[-1][-1] if at else OTHER, alphabet))
                    size += len(held[-1])
        add()
        total.reshape(symbols, symbols, symbols)[:, END, END] = 0  # only where one text ends and the next begins
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])], ["trigram", "n"])

    counted = docs.select("text").mapInArrow(count, "trigram bigint, n bigint")
    return counted.groupBy("trigram").agg(F.sum("n").alias("n"))


def _codes(lower: str, first: bool, last: bool, before: int, alphabet: Alphabet = LATIN) -> np.ndarray:
    """Symbols of a text, or of a piece of it behind the symbol ``before``, with white space and the text's ends as word ends."""
    try:
        c = np.frombuffer(lower.encode("latin-1", "strict" if alphabet.more else "replace"), np.uint8)
    except UnicodeEncodeError:
        c = np.frombuffer(lower.encode("utf-32-le", "replace"), np.uint32)
    c = alphabet.codes[c].astype(np.int64)
    c = np.concatenate([_START if first else _NONE, c, _STOP if last else _NONE])
    kept = c != END
    kept[1:] |= c[:-1] != END
    kept[: 2 * first] = True
    if not first and len(c):
        kept[0] = c[0] != END or before != END
    return c[kept]


def language_model(counts: np.ndarray) -> np.ndarray:
    """Cost in nats of each symbol after two others, trigrams backed by bigrams and single symbols."""
    symbols = round(len(counts) ** (1 / 3))
    n = counts.reshape(symbols, symbols, symbols).astype(float)
    one = n.sum(axis=(0, 1)) + 0.5
    one /= one.sum()
    pairs = n.sum(axis=0)
    two = (pairs + 8 * one) / (pairs.sum(axis=1, keepdims=True) + 8)
    three = (n + 8 * two[None]) / (n.sum(axis=2, keepdims=True) + 8)
    return (-np.log(three)).astype(np.float32)


@dataclass
class Decoder:
    """Reads words as what was most likely meant; remembers what it has read."""

    cost: np.ndarray
    alphabet: Alphabet = LATIN
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)
    gaps: dict[str, tuple[bool, ...]] = field(default_factory=dict)
    repeats: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.seen = Seen(self)
        # one price at a time is read faster from here than from an array
        self.prices = memoryview(np.ascontiguousarray(self.cost).ravel())

    def read(self, word: str) -> tuple[str, ...]:
        """A lower-case token's restored words; a token of plain letters is its own, and with doubled ones also what they may be short for."""
        core = word.strip(_PUNCTUATION)
        if not _TWICE.search(core) and (core.isascii() and core.isalpha() or self.alphabet.plain.fullmatch(self.alphabet.own(core))):
            return (core,)
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[word] = self._read(word)
        return found

    def _read(self, word: str) -> tuple[str, ...]:
        core = self.alphabet.own(bare(word))
        if not core:
            return ()
        if self.alphabet.plain.fullmatch(core) and not _THRICE.search(core):
            return tuple(dict.fromkeys([self.alphabet.shown(core), self.alphabet.shown(self.squeezed(core))]))
        return tuple(w for w in self.viterbi(core).split() if w)

    def squeezed(self, letters: str) -> str:
        """What ``viterbi`` reads in a word of plain letters.

        Only repeated letters leave a choice there; the letter before them and
        the one behind fix the lattice's states, so each such place is decided
        on its own.
        """

        def kept(found: re.Match) -> str:
            start, end = found.span()
            key = letters[start - 1 : end + 1] if start else " " + letters[: end + 1]
            size = self.repeats.get(key)
            if size is None:
                size = self._repeats(letters, start, end)
                if len(self.repeats) < MEMORY:
                    self.repeats[key] = size
            return found[1] * size

        return _REPEATS.sub(kept, letters)

    def _repeats(self, letters: str, start: int, end: int) -> int:
        """How many of a run of one letter are meant."""
        index = self.alphabet.index
        before = index[letters[start - 1]] if start else END
        behind = index[letters[end]] if end < len(letters) else END
        a, size, cost = index[letters[start]], end - start, self.cost
        paid = [float(cost[before, a, behind]) + (size - 1) * DROP_REPEAT]
        for k in range(2, size + 1):
            more = cost[before, a, a] + (k - 2) * cost[a, a, a] + cost[a, a, behind]
            paid.append(float(more) + (size - k) * DROP_REPEAT)
        return 1 + paid.index(min(paid))

    def viterbi(self, text: str) -> str:
        """The cheapest reading of a token or of letters spaced out."""
        return self.alphabet.shown(self._path(text).replace("\n", ""))

    def _path(self, text: str) -> str:
        """The cheapest reading, with a line feed for each space that is read as nothing.

        Every character offers what it may stand for: a letter itself, a digit
        or sign the letters it looks like or (a sign at the edges cheaply)
        nothing, the repetition of a letter nothing too, a space a word's end
        or nothing. States are the last two symbols read; the language model
        pays for each step.
        """
        prices, symbols, index, readings, solid = self.prices, self.alphabet.symbols, self.alphabet.index, self.alphabet.readings, self.alphabet.solid
        letters = [k for k, c in enumerate(text) if c in index]
        inside = range(letters[0], letters[-1]) if letters else range(0)
        # a state is the two symbols as one number
        states: dict[int, tuple[float, tuple | None]] = {END * symbols + END: (0.0, None)}
        before = ""
        for at, c in enumerate(text):
            options: list[tuple[str, float]] = []
            if c in index:
                options.append((c, 0.0))
                if c == before:
                    options.append(("", DROP_REPEAT))
            elif c == " ":
                options += [(" ", 0.0), ("", DROP_SPACE)]
            else:
                options += readings.get(c, ())
                drop = 0.0 if c not in readings else DROP_INSIDE if c.isalnum() or c in solid or at in inside else DROP_AT_EDGE
                options.append(("", DROP_REPEAT if c == before and c in solid else drop))
            step: dict[int, tuple[float, tuple | None]] = {}
            moves = [(letter, END if letter == " " else index[letter] if letter else -1, price) for letter, price in options]
            for state, (paid, back) in states.items():
                row, last = state * symbols, state % symbols * symbols
                for letter, s, price in moves:
                    if letter:
                        to, total = last + s, paid + price + prices[row + s]
                        if to not in step or total < step[to][0]:
                            step[to] = total, (letter, back)
                    else:
                        total = paid + price
                        if state not in step or total < step[state][0]:
                            step[state] = total, ("\n", back) if c == " " else back
            states, before = step, c
        _, path = min((paid + prices[state * symbols + END], k, path) for k, (state, (paid, path)) in enumerate(states.items()))[::2]
        out = []
        while path:
            letter, path = path
            out.append(letter)
        return "".join(reversed(out))

    def words(self, text: str | None) -> set[str]:
        """The distinct words of a text as restored, spelt-out and joined ones too."""
        at = self.shaped((text or "").lower().split())
        found = {w for k in set(at.tolist()) for w in self.read(self.seen.tokens[k])}
        for _, spelt in self.seen.spelt_out(at):
            found.update(self.read_spelt(spelt))
        for word in self.joined(at):
            found.update(self.read_joined(word))
        return found

    def shaped(self, tokens: list[str]) -> np.ndarray:
        """The tokens' numbers in ``seen``, which knows their shapes."""
        return self.seen.numbers(tokens)

    def joined(self, shaped: np.ndarray) -> set[str]:
        """Neighbouring tokens, run together where the cheapest reading of the text has no space between them."""
        return {word for _, word, _ in self.seen.joined(shaped)}

    def shape(self, token: str) -> tuple[str, str, str]:
        """A token without the signs at its edges, its beginning up to its first two different letters, and its end from the last two on."""
        core = token.strip(_PUNCTUATION)
        if core.isascii() and core.isalpha() and len(core) > 1 and core[0] != core[1] and core[-1] != core[-2]:
            return core, core[:2], core[-2:]
        core = token if len(token) == 1 else self.alphabet.own(bare(token))
        first, last = self.alphabet.pair.search(core), self.alphabet.pair.search(core[::-1])
        return (core, core[: first.end()], core[len(core) - last.end() :]) if first and last else (core, "", "")

    def gap(self, key: str) -> tuple[bool, ...]:
        """``dropped``, remembered."""
        dropped = self.gaps.get(key)
        if dropped is None:
            dropped = self.dropped(key)
            if len(self.gaps) >= MEMORY:
                self.gaps.clear()
            if len(key) <= LONG_KEY:
                self.gaps[key] = dropped
        return dropped

    def dropped(self, text: str) -> tuple[bool, ...]:
        """Which spaces of a text the cheapest reading leaves out."""
        plain, index = self.alphabet.plain, self.alphabet.index
        if len(text) == 5 and text[2] == " " and plain.fullmatch(text[:2]) and plain.fullmatch(text[3:]) and text[0] != text[1] and text[3] != text[4]:
            a, b, c, d, cost = *(index[x] for x in text.replace(" ", "")), self.cost  # two readings only
            apart = float(cost[a, b, END]) + float(cost[b, END, c]) + float(cost[END, c, d])
            return (float(cost[a, b, c]) + float(cost[b, c, d]) + DROP_SPACE < apart,)
        return tuple(c == "\n" for c in self._path(text) if c in " \n")

    def read_joined(self, word: str) -> tuple[str, ...]:
        """Like ``read``; words of plain letters are not remembered, as few occur twice."""
        own = self.alphabet.own(word)
        if not self.alphabet.plain.fullmatch(own) or _THRICE.search(own):
            return self.read(word)
        return (word, self.alphabet.shown(self.squeezed(own))) if _TWICE.search(own) else (word,)

    def read_spelt(self, letters: tuple[str, ...]) -> tuple[str, ...]:
        key = " ".join(letters)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= MEMORY:
                self.known.clear()
            found = self.known[key] = tuple(w for w in {*self.viterbi(self.alphabet.own(key)).split(), *self.read("".join(letters))} if len(w) > 1)
        return found


class Numbers(dict):
    """Numbers tokens as they come."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens

    def __missing__(self, token: str) -> int:
        at = self[token] = len(self.tokens)
        self.tokens.append(token)
        return at


class PairCodes(dict):
    """The codes of two ASCII letters, of which there are few."""

    def __init__(self, alphabet: Alphabet):
        self.alphabet = alphabet

    def __missing__(self, two: str) -> int:
        code = self[two] = self.alphabet.pair_code(two)
        return code


class Seen:
    """The distinct tokens of many texts by number, with what joins need to know of each in arrays.

    Texts become arrays of numbers, so what is true of each token or gap is
    looked up for all of them at once, and a token is taken apart once. Texts
    in one array are parted by ``BOUND``, which joins nothing.
    """

    def __init__(self, decoder: Decoder, room: int = MEMORY):
        self.decoder, self.alphabet, self.room = decoder, decoder.alphabet, room
        self.cost, self.symbols = decoder.cost.ravel(), decoder.alphabet.symbols
        self.forgotten = -1
        self.pairs = PairCodes(self.alphabet)
        # kind, code of the two letters a token begins with and ends with (-1: more than these), length of its core, whether all letters
        self.facts = np.empty((256, 5), np.int32)
        self.forget()

    def forget(self) -> None:
        self.forgotten += 1
        self.tokens: list[str] = ["  "]
        self.number = Numbers(self.tokens)
        self.shapes: list[tuple[str, str, str]] = [("  ", "", "")]
        self.facts[BOUND] = FOREIGN, -1, -1, 2, 0

    def numbers(self, *texts: list[str]) -> np.ndarray:
        """Each token's number, with ``BOUND`` between texts; the same ones until tokens are forgotten, which only happens here."""
        if len(self.tokens) > self.room:
            self.forget()
        number, out = self.number.__getitem__, []
        for tokens in texts:
            if out:
                out.append(BOUND)
            out += map(number, tokens)
        if len(self.tokens) > len(self.shapes):
            self.add(len(self.shapes))
        return np.array(out, np.int64)

    def add(self, start: int) -> None:
        """Take the tokens from ``start`` on apart."""
        shape, facts, known, readings, pair_code = self.decoder.shape, [], self.alphabet.index, self.alphabet.readings, self.alphabet.pair_code
        shapes, pairs = self.shapes, self.pairs
        for token in self.tokens[start:]:
            core = token.strip(_PUNCTUATION)
            if core.isascii() and core.isalpha() and len(core) > 1 and core[0] != core[1] and core[-1] != core[-2]:
                # most tokens; as below, with two letters' code looked up
                found = core, beginning, ending = core, core[:2], core[-2:]
                facts += PAIRED, pairs[beginning], pairs[ending], len(core), True
                shapes.append(found)
                continue
            found = core, beginning, ending = shape(token)
            if beginning:
                kind = PAIRED
            elif core and all(c in known or c in readings for c in core):
                kind = BETWEEN
            else:
                kind = FOREIGN if any(c.isalnum() for c in core) else SIGNS
            letters = core.isalpha() if core.isascii() else self.alphabet.plain.fullmatch(core) is not None
            facts += kind, pair_code(beginning), pair_code(ending), len(core), letters
            shapes.append(found)
        if len(self.tokens) > len(self.facts):
            more = np.empty((max(len(self.tokens), 2 * len(self.facts)) - len(self.facts), 5), np.int32)
            self.facts = np.concatenate([self.facts, more])
        self.facts[start : len(self.tokens)] = np.array(facts, np.int32).reshape(-1, 5)

    def spelt_out(self, at: np.ndarray) -> list[tuple[int, tuple[str, ...]]]:
        """Runs of at least three single characters that aren't all the same, and where they begin; nothing is left of a token of signs."""
        size = self.facts[at, 3]
        longer = size > 1
        singles = np.cumsum(size == 1)
        if not len(at) or singles[-1] < 3:
            return []
        ends = np.append(np.flatnonzero(longer), len(at))  # runs lie between longer tokens
        held = np.diff(np.append(0, np.append(singles, singles[-1])[ends]))
        out = []
        for k in np.flatnonzero(held >= 3):
            start = int(ends[k - 1]) + 1 if k else 0
            run = tuple(c for t in at[start : ends[k]] for c in self.shapes[t][0])
            if len(set(run)) > 1:
                out.append((start, run))
        return out

    def joined(self, at: np.ndarray, matters: np.ndarray | None = None) -> Iterator[tuple[int, str, bool]]:
        """Neighbouring tokens, run together where the cheapest reading of the text has no space between them.

        Also where they begin and whether all are letters. Between two
        different letters in one token and two in a later one, the lattice
        starts and ends in one state, so these stretches are searched one by
        one and remembered, and together are the search of the whole text. A
        token with letters the model doesn't have is not joined. Of runs of
        letters only, those whose first token ``matters`` (by number) are
        returned.
        """
        place = np.flatnonzero(self.facts[at, 0] != SIGNS)
        at = at[place]
        together = np.flatnonzero(self.together(at))
        if not len(together):
            return
        parts = np.flatnonzero(np.diff(together) > 1)
        first = together[np.append(0, parts + 1)]
        last = together[np.append(parts, len(together) - 1)] + 2
        others = np.append(0, np.cumsum(self.facts[at, 4] == 0))
        plain = others[last] == others[first]
        if matters is not None:
            some = matters[at[first]] | ~plain
            first, last, plain = first[some], last[some], plain[some]
        numbers, shapes = at.tolist(), self.shapes
        for f, l, letters, where in zip(first.tolist(), last.tolist(), plain.tolist(), place[first].tolist(), strict=True):
            yield where, self.alphabet.shown("".join([shapes[t][0] for t in numbers[f:l]])), letters

    def together(self, at: np.ndarray) -> np.ndarray:
        """Which tokens the cheapest reading joins to the next one."""
        kind, begins, ends = self.facts[at, 0], self.facts[at, 1], self.facts[at, 2]
        out = np.zeros(max(0, len(at) - 1), bool)
        paired = (kind[:-1] == PAIRED) & (kind[1:] == PAIRED)
        end, begin = ends[:-1].astype(np.int64), begins[1:].astype(np.int64)
        plain = np.flatnonzero(paired & (end >= 0) & (begin >= 0))
        # two readings only: with the space and without
        a_b, c_d = end[plain], begin[plain]
        symbols = self.symbols
        b, c = a_b % symbols * symbols**2, c_d // symbols
        cost = lambda k: self.cost[k].astype(np.float64)
        apart = cost(a_b * symbols + END) + cost(b + END * symbols + c) + cost(END * symbols**2 + c_d)
        out[plain] = cost(a_b * symbols + c) + cost(b + c_d) + DROP_SPACE < apart
        shapes, gap, numbers = self.shapes, self.decoder.gap, at.tolist()
        others = np.flatnonzero(paired & ((end < 0) | (begin < 0))).tolist()
        if others:
            out[others] = [gap(f"{shapes[numbers[k]][2]} {shapes[numbers[k + 1]][1]}")[0] for k in others]
        between = np.flatnonzero(kind == BETWEEN)
        if not len(between):
            return out
        parts = np.flatnonzero(np.diff(between) > 1)
        firsts, lasts = between[np.append(0, parts + 1)], between[np.append(parts, len(between) - 1)]
        pairs = np.append(kind == PAIRED, False)  # the last also stands before the first
        for first, last, left, right in zip(firsts.tolist(), lasts.tolist(), pairs[firsts - 1].tolist(), pairs[lasts + 1].tolist(), strict=True):
            key = [shapes[t][0] for t in numbers[first : last + 1]]
            if left:
                first -= 1
                key.insert(0, shapes[numbers[first]][2])
            if right:
                last += 1
                key.append(shapes[numbers[last]][1])
            if last > first:
                out[first:last] = gap(" ".join(key))
        return out


# Kinds of tokens: with two different letters side by side, without but readable, with letters the model lacks, without any sign of a letter.
PAIRED, BETWEEN, FOREIGN, SIGNS = range(4)
BOUND = 0


def beginnings(word: str) -> list[str]:
    """A word's features: its beginnings, marked as such, and the word."""
    return [word[:k] + "-" for k in range(SHORTEST, min(LONGEST, len(word) - 1) + 1)] + [word]


class Marks:
    """Which weighed features a text's restored words have; remembers tokens."""

    def __init__(self, decoder: Decoder, weight: dict[str, float]):
        self.decoder, self.weight = decoder, weight
        self.starts = {f[:SHORTEST] for f in weight}
        self.seen = decoder.seen
        self.known: dict[int, tuple[str, ...]] = {}
        self.read, self.forgotten = BOUND + 1, 0
        # by number of the token: whether it has marks, and whether it or a run that it starts may have any
        self.marked, self.matters = np.zeros(256, bool), np.zeros(256, bool)

    def of_texts(self, texts: list[str | None]) -> list[set[str]]:
        seen, found = self.seen, [set() for _ in texts]
        if not texts:
            return found
        at = seen.numbers(*((text or "").lower().split() for text in texts))
        self._read_new()
        bounds = np.flatnonzero(at == BOUND)
        hits = np.flatnonzero(self.marked[at])
        for k, t in zip(np.searchsorted(bounds, hits).tolist(), at[hits].tolist(), strict=True):
            found[k].update(self.known[t])
        for place, spelt in seen.spelt_out(at):
            found[np.searchsorted(bounds, place)].update(self._of(self.decoder.read_spelt(spelt)))
        for place, word, letters in seen.joined(at, self.matters):
            if self._may(word, letters) and (own := self._of(self.decoder.read_joined(word))):
                found[np.searchsorted(bounds, place)].update(own)
        return found

    def _may(self, word: str, letters: bool) -> bool:
        """Whether a word may be read as one with a feature.

        Its first letters, a-z and none like the one before, are read as
        themselves whatever follows, as only signs, digits and repetitions
        leave a choice; so it is known how the word begins.
        """
        start = word[:SHORTEST]
        if not letters and not (start.isascii() and start.isalpha() and self.decoder.alphabet.own(word) == word):
            return True
        return start in self.starts or len(word) < SHORTEST or word[0] == word[1] or word[1] == word[2]

    def _read_new(self) -> None:
        """Marks of the tokens seen since; all anew when tokens were forgotten."""
        tokens, shapes, shown = self.seen.tokens, self.seen.shapes, self.seen.alphabet.shown
        if self.forgotten != self.seen.forgotten:
            self.read, self.forgotten = BOUND + 1, self.seen.forgotten
            self.marked[:] = False
            self.known.clear()
        if len(tokens) > len(self.marked):
            more = np.zeros(max(len(tokens), 2 * len(self.marked)) - len(self.marked), bool)
            self.marked, self.matters = np.append(self.marked, more), np.append(self.matters, more)
        letters, may = self.seen.facts[self.read : len(tokens), 4].tolist(), []
        for k, plain in enumerate(letters, self.read):
            word = shown(shapes[k][0])
            matters = self._may(word, plain)
            may.append(matters)
            if matters and (own := self._of(self.decoder.read(tokens[k]))):
                self.known[k], self.marked[k] = own, True
        self.matters[self.read : len(tokens)] = may
        self.read = len(tokens)

    def _of(self, words: tuple[str, ...]) -> tuple[str, ...]:
        # few words begin like a feature
        return tuple(f for w in words if w[:SHORTEST] in self.starts for f in beginnings(w) if f in self.weight)


def restored_words(docs: DataFrame, cost: np.ndarray, keep: tuple[str, ...] = ("doc_id",), alphabet: Alphabet = LATIN) -> DataFrame:
    """The columns ``keep`` and the distinct restored ``words`` of each text."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((cost, alphabet))  # 1 to 28 megabytes
    kept = docs.select(*keep, "text")
    types = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in keep)

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(*sent.value)
        for batch in batches:
            words = pa.array([sorted(decoder.words(t.as_py())) for t in batch.column("text")], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), words], [*keep, "words"])

    return kept.mapInArrow(restore, f"{types}, words array<string>")


def selected(sample: DataFrame) -> list[str]:
    """The features that tell the sample's ``words, toxic`` apart best, by the gain of information."""
    toxic, clean = (sample.where(F.col("toxic") == t).count() for t in (1, 0))
    if not toxic or not clean:
        return []
    word = F.col("word")
    starts = F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), F.length(word) - 1)), lambda k: F.concat(F.substring(word, F.lit(1), k), F.lit("-"))
    )
    none = F.array().cast("array<string>")
    features = F.array_append(F.when(F.length(word) > SHORTEST, starts).otherwise(none), word)
    of_toxic = sample.where("toxic = 1").select("doc", F.explode("words").alias("word"))
    likely = of_toxic.select("doc", F.explode(features).alias("feature")).distinct().groupBy("feature").agg(F.count("*").alias("t"))
    likely = written(likely.where(F.col("t") >= LEAST_DOCS))
    of_clean = sample.where("toxic = 0").select("doc", F.explode("words").alias("word"))
    seen = of_clean.select("doc", F.explode(features).alias("feature")).join(likely, "feature", "left_semi").distinct()
    counts = likely.join(seen.groupBy("feature").agg(F.count("*").alias("c")), "feature", "left").fillna(0, ["c"])
    # gain against the label, in nats, for features that speak for toxicity
    t, c, all_docs = F.col("t"), F.col("c"), float(toxic + clean)
    rate = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    inside, outside = t + c, all_docs - t - c
    gain = rate(t, inside) + rate(c, inside) + rate(toxic - t, outside) + rate(clean - c, outside)
    best = counts.where(t / toxic > 2 * c / clean).orderBy(gain.desc(), "feature").limit(FEATURES)
    return [r[0] for r in best.select("feature").collect()]


def logistic(rows: list[np.ndarray], labels: np.ndarray, width: int, penalty: float = PENALTY, rounds: int = 800) -> tuple[np.ndarray, float]:
    """Weights and offset that minimise the log loss plus ``penalty`` times the weights' sum.

    ``rows`` list each document's features. Weights stay at least 0, as
    features speak for toxicity only. Proximal steps, accelerated, each weight
    with the longest step its curvature surely allows.
    """
    n, sizes = len(rows), np.array([len(r) for r in rows])
    at = np.repeat(np.arange(n), sizes)
    which = np.concatenate(rows).astype(np.int64) if len(at) else np.empty(0, np.int64)
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    weights, offset = np.zeros(width), float(np.log(rate / (1 - rate)))
    ahead, ahead_offset, t = weights, offset, 1.0
    step = 4.0 / np.maximum(np.bincount(which, sizes[at] + 1.0, width), 1.0)
    step_offset = 4.0 / (sizes + 1.0).sum()
    for _ in range(rounds):
        margin = ahead_offset + np.bincount(at, ahead[which], n)
        wrong = 0.5 * (1 + np.tanh(margin / 2)) - labels
        new = np.maximum(ahead - step * (np.bincount(which, wrong[at], width) + penalty), 0)
        new_offset = ahead_offset - step_offset * wrong.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        pace = (t - 1) / t_next
        ahead, ahead_offset = new + pace * (new - weights), new_offset + pace * (new_offset - offset)
        weights, offset, t = new, new_offset, t_next
    return weights, offset


def toxicity_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, score`` for each row of ``docs(doc_id, text)``: the probability of toxicity.

    ``labels(doc_id, toxic)`` are learnt from as they come. Character trigrams
    of all texts make the language model; words with signs, digits, spacing
    (between any tokens) or repetition (of two letters or more) are read by a Viterbi search under it; beginnings of the
    restored words are weighed by a sparse logistic classifier fitted on a
    bounded sample. Whole texts are read: in one pass for the alphabet, one for the model and one for
    the scores. Letters of any script are read as themselves, and in words with
    letters of another script look-alikes are read as what fits best.

    A null or empty text has no words and scores the classifier's offset; null
    ids are scored but not learnt from; repeated rows are all scored, and of the
    rows of one id the one with the smallest hash is learnt from; an empty
    table gives no rows. Without labels of both kinds every score is the share
    of toxic labels (0 without any). Columns other than those named are ignored.
    """
    docs = docs.select("doc_id", "text")
    alphabet = corpus_alphabet(docs)
    counts = np.zeros(alphabet.symbols**3, np.int64)
    counted = trigram_counts(docs, alphabet).toArrow()  # bounded by the alphabet
    counts[counted.column("trigram").to_numpy()] = counted.column("n").to_numpy()
    cost = language_model(counts)
    marked = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = written(sampled(marked, "doc_id", fit_rows))
    learnt = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = written(restored_words(learnt, cost, ("doc_id", "toxic"), alphabet).withColumn("doc", F.monotonically_increasing_id()))
    features = selected(sample)
    number = {f: k for k, f in enumerate(features)}
    weights, offset = _fit(sample, number)
    weight = {f: float(weights[k]) for f, k in number.items() if weights[k] > 0}
    sent = docs.sparkSession.sparkContext.broadcast((cost, alphabet, weight))  # bounded by the alphabet and FEATURES
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, alphabet, weight = sent.value
        marks = Marks(Decoder(cost, alphabet), weight)
        for batch in batches:
            margins = [offset + sum(weight[f] for f in sorted(own)) for part in _parts(batch.column("text")) for own in marks.of_texts(part)]
            score = 0.5 * (1 + np.tanh(np.array(margins, float) / 2))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {id_type}, score double")


def _parts(texts: pa.Array) -> Iterator[list[str | None]]:
    """Consecutive texts of about ``CHUNK`` characters together."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1] or "")
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _fit(sample: DataFrame, number: dict[str, int]) -> tuple[np.ndarray, float]:
    """The classifier on the sample; only the chosen features of its documents reach the driver."""
    marks = sample.select("toxic", "words").mapInArrow(_marking(number), "toxic int, marks array<int>").toArrow()
    labels = marks.column("toxic").to_numpy().astype(float)
    if not len(labels) or labels.min() == labels.max():
        rate = float(np.clip(labels.mean(), 1e-9, 1 - 1e-9)) if len(labels) else 1e-9
        return np.zeros(len(number)), float(np.log(rate / (1 - rate)))
    rows = [np.array(x, np.int64) for x in marks.column("marks").to_pylist()]
    return logistic(rows, labels, len(number))


def _marking(number: dict[str, int]):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, marks = [], []
            for label, words in zip(batch.column("toxic").to_pylist(), batch.column("words").to_pylist(), strict=True):
                of_word = [(w, [number[f] for f in beginnings(w) if f in number]) for w in words]
                for copy in range(1 + THINNED * label):
                    kept = (m for w, m in of_word if m and (not copy or xxhash.xxh64_intdigest(w, copy) % THINNED == 0))
                    marks.append(sorted({k for m in kept for k in m}))
                    toxic.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(marks, pa.list_(pa.int32()))], ["toxic", "marks"])

    return mark


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    labels = table(spark, sf_dir, "labels").where(learns(F.col("doc_id"))).select("doc_id", "toxic")
    scores = toxicity_scores(table(spark, sf_dir, "documents"), labels)
    return scores.select(
        "doc_id",
        F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
