"""Personal information in free text: email addresses, phone numbers, identity numbers, street addresses, names.

Generous patterns propose candidate places of each kind. Labelers (formats, gazetteers of names, words around the
place) vote on each candidate: yes, no or no opinion. How often each pattern of votes occurs is counted over the
whole corpus; expectation-maximisation estimates on these counts how reliable each labeler is, without any labelled
text. The posteriors label a bounded sample of candidates, on which a logistic span classifier over votes and the
words' spelling is trained; it decides on every candidate, and overlaps of accepted places are resolved per text.

Proposing takes time linear in the text, whatever it holds: repetitions are unbounded but never tried twice, and
names are read off a row of tokens instead of being searched from each place.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.plaintext import UPPER, Plain, plain
from citeloom.session import materialize, spread

KINDS = ("email", "phone", "id_number", "address", "name")
#: Candidates of one pattern of votes on which the classifier is trained, about so many at most.
SAMPLE_PER_PATTERN = 100
#: Names that are sent to every task; more in the gazetteer are an error, more learned ones are joined.
MAX_NAMES = 200_000
#: An unlisted word is a given name if, with this many standard deviations of certainty, at least half of the pairs it opens have a known surname.
CERTAINTY = 1.28
#: Vote of the surname lists on a surname that they neither hold nor resemble: lists are incomplete, so it is no evidence.
UNLISTED = 2
#: Features of the span classifier, and how many a candidate has at most; the place behind the last is for none.
DIMENSIONS = 1 << 13
SLOTS = 16

# --- candidates -------------------------------------------------------------------------------------------------

# A pattern opens with a class of characters, which the matcher skips to, and looks at what is before it after that.
_SIGN = re.compile(r"[@\[({aA](?:(?<=@)|(?<=[\[({])\s?[aA][tT]\s?[\])}]|(?<=\s[aA])[tT](?=\s[\w\-]++\s?[\[({]?\s?(?i:dot)\b))")
_DOT = r"(?:\.|\s?[\[({]\s?(?i:dot)\s?[\])}]\s?|\s(?i:dot)\s)"
_HOST = re.compile(rf"[\w\-]++(?:{_DOT}[\w\-]++)*+")
_DOTS = re.compile(_DOT)
_LABELS = re.compile(r"[\w\-]+")

_SEP = r"(?:\)[ .\-/]?|[ ]?\(|[ .\-/])"
_PHONE = re.compile(rf"(?s:[+(\d](?<![\w@.+/\-].)(?<!\d .))(?:(?<=\d)|(?<=[+(])\d)\d*+(?:{_SEP}\d++)*(?![\w@])")

_RUN = re.compile(r"\d++")
_ID_END = r"(?![\w@]|[\-/]\d)"
_ID_DIGITS = re.compile(rf"(?:\d{{4}}-\d{{4}}(?:-\d{{4}}-\d{{3}}[\dXx])?|\d{{3}}([ \-])\d{{2}}\1\d{{4}}|\d{{2}}([ /])\d{{3}}\2\d{{3}}\2\d{{3}}|\d{{11}}|\d{{3}}/\d{{4}}){_ID_END}")
_ID_LETTERS = re.compile(rf"(?:[A-Za-z]{{2}} \d{{2}} ?\d{{2}} ?\d{{2}} ?[A-Da-d]|[A-Z]{{1,2}} \d{{6,8}}|[A-Za-z]{{1,2}}-?\d{{2,4}}(?:[ \-]?\d{{2,4}}){{1,3}}(?:[ \-]?[A-Za-z0-9])?){_ID_END}")
_ID_LEAD = re.compile(r"(?<![\w@/.\-])[A-Za-z]{1,2}[ \-]?\Z")

_L = r"[^\W\d_]"
_CAP = rf"[{UPPER}](?:{_L}|['’\-])*+"
_POST = r"\d{4,5}"
_LEFT = r"(?<![\w.\-/])"
_STREETS = (
    # number, name, kind of street; unit; town with post code before or behind it
    re.compile(rf"\d(?<![\w.\-/]\d)\d{{0,3}}[A-Za-z]?,? (?:{_CAP} )+(?i:street|st|lane|ln|avenue|ave|road|rd|drive|boulevard|blvd|court|way|close|square|terrace)\b\.?(?:, (?i:unit|flat|apt|apartment|suite)\.? \w+)?,? {_CAP}(?:,? {_POST}\b)?"),
    re.compile(rf"\d(?<![\w.\-/]\d)\d{{0,3}}(?: ?(?i:bis|ter))?,? (?i:rue|avenue|av\.|bd\.?|boulevard|place|chemin|allée|quai|impasse|cours)(?: (?i:de la|de l'|des|du|de|d'))? {_CAP},? (?:{_POST} )?{_CAP}"),
    re.compile(rf"{_LEFT}(?i:calle|c/|avda\.?|avenida|plaza|paseo|camino|ronda)(?: (?i:de la|de los|del|de))? {_CAP},? (?:(?i:n\.?o\.?|núm\.?) ?)?\d{{1,4}}(?:, \w+ \w)?, (?:{_POST} )?{_CAP}"),
    re.compile(rf"{_LEFT}(?:(?i:am|an der|an den|auf dem|im|in der|zum|zur) )?[{UPPER}](?:{_L}|-)*(?i:straße|strasse|str\.|gasse|platz|weg|allee|damm|ufer|ring) \d{{1,4}} ?[A-Za-z]?(?:,| (?i:in))(?: {_POST})? {_CAP}"),
)
# What a street line of the last two patterns must have in it: a word, or the end of the word before a number.
_CALLES = ("calle", "c/", "avda", "avenida", "plaza", "paseo", "camino", "ronda")
_STREET_ENDS = ("straße", "strasse", "str.", "gasse", "platz", "weg", "allee", "damm", "ufer", "ring")

#: Initials, or a capitalised word with its hyphens: what names are made of.
_TOKEN = re.compile(rf"(?s:[{UPPER}](?<![\w@.\-–].))(?:\.(?:[ \-]?[{UPPER}]\.)*+|(?:(?<=[OD])['’][{UPPER}](?={_L}))?{_L}++(?:-[{UPPER}]{_L}++)*+)")
_PARTICLES = ("van der", "van den", "von der", "von den", "de la", "de los", "della", "van", "von", "vom", "zu", "den", "del", "de", "du", "di", "da", "la", "le", "ter", "ten")
_GAPS = frozenset([" ", *(f" {p} " for p in _PARTICLES)])
_PART_BEFORE = re.compile(rf"(?<![\w@.\-–])(?:{'|'.join(_PARTICLES)}) \Z")

#: Words before a place that speak for or against a kind, in English, German, Spanish and French.
_FOR = {
    "email": "mail email e-mail mailto to or oder ou o en at contact contacto über",
    "phone": "phone tel telephone telefon telefono teléfono téléphone call voice fax mobile mobil ruf",
    "id_number": "identity identité identidad steuernummer ssn orcid passport record",
    "address": "adresse anschrift dirección address office at über en from",
}
_AGAINST = {
    "email": "tag version",
    "phone": "issn isbn pages pp arxiv doi grant nummer res report claim preprint points entry eintrag notice registro no number section equation table figure identity identité identidad steuernummer record dossier expediente",
    "id_number": "issn isbn pages pp claim grant report nummer dossier expediente no phone tel call voice telefon teléfono téléphone res preprint arxiv doi",
    "address": "section table figure equation",
}
_CONTEXT = {k: (frozenset(_FOR[k].split()), frozenset(_AGAINST[k].split())) for k in _FOR}
#: Words that open a sentence or stand before a surname without being a given name.
_NOT_GIVEN = frozenset("the as a an in by to of for from with and or but if when our we both das der die den dem des ein eine wie und oder nach laut von bei mit según el la los las un una y como por con d après selon le les une et de du comme par avec dr prof mr mrs ms herr frau mme mlle sr sra señor señora thanks dank contact contacto see siehe voir véase signed reviewed reprints section table figure journal acta proceedings letters review archive institute university".split())
_TITLES = frozenset("dr dra prof professor professeur profesor profesora mr mrs ms herr herrn frau m mme mlle sr sra señor señora".split())
_ARTICLES = frozenset("a an the".split())
#: Words behind a surname that make it the name of something else.
_GROUPS = frozenset("institute institut instituto collaboration group gruppe grupo groupe lemma theorem university universität et working detector archive review letters journal".split())
#: Words before a name that is given as a person's.
_PERSONS = frozenset("thank thanks dank danken gracias remercie remercions by author autor auteur dear".split())

# What follows a word that belongs to the short title of a journal, as in "J. Phys. Rev. 4" or "J. Word Res. 4".
_SHORT = re.compile(rf"\.?(?: [{UPPER}]{_L}*+\.)++")
_VOLUME = re.compile(r",? \d")

_TEXT_WORD = re.compile(r"[^\W_]++(?:['’\-]++[^\W_]*+)*+")


class Candidate(NamedTuple):
    """A proposed place; given and tail are the given name and the surname's end that unlisted given names are learned from."""

    kind: str
    start: int
    end: int
    votes: tuple[int, ...]
    slots: list[int]
    given: str | None = None
    tail: str | None = None


class Gazetteer:
    """Known names, and the ends that known surnames have in common: surnames that are not listed are often built alike."""

    def __init__(self, given: Iterable[str], surnames: Iterable[str]) -> None:
        self.given = {x.casefold() for x in given if x}
        self.surnames = {x.casefold() for x in surnames if x}
        long = [x for x in self.surnames if len(x) >= 5]
        self.heads, self.tails = {x[:3] for x in long}, {x[-3:] for x in long}

    def is_given(self, word: str) -> bool:
        return any(x in self.given for x in word.casefold().split("-"))

    def is_surname(self, word: str) -> bool:
        return any(x in self.surnames for x in word.casefold().split("-"))

    def like_surname(self, word: str) -> bool:
        return all(len(x) >= 5 and x[:3] in self.heads and x[-3:] in self.tails for x in word.casefold().split("-"))


def _vote(yes: bool, no: bool = False) -> int:
    return 1 if yes else -1 if no else 0


def _context(kind: str, words: Sequence[str]) -> tuple[int, int]:
    """(vote for, vote against) by the words before a place, nearest first; the nearest telling word decides."""
    yes, no = _CONTEXT[kind]
    for w in words:
        if w in no:
            return 0, -1
        if w in yes:
            return 1, 0
    return 0, 0


_PHONE_FORMS = [
    re.compile(p)
    for p in (
        r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{1,5}(?:[ .\-/]?\d{2,8}){1,5}$",
        r"\+\d{9,14}$",
        r"00\d{1,3}[ .\-]\d{1,5}(?:[ .\-/]\d{2,8}){1,5}$",
        r"\(0?\d{2,5}\)[ ]?\d{3,8}(?:[ .\-]\d{3,4})?$",
        r"0\d{1,4}(?:[ \-/]\d{2,8}){1,5}$",
        r"0\d{1,4}(?:\.\d{2,5}){2,5}$",
        r"[2-9]\d{2}([ .\-])\d{3}\1\d{4}$",
    )
]
_ID_FORMS = [
    re.compile(p)
    for p in (
        r"\d{4}-\d{4}-\d{4}-\d{3}[\dXx]$",
        r"\d{3}([ \-])\d{2}\1\d{4}$",
        r"\d{2}([ /])\d{3}\1\d{3}\1\d{3}$|\d{11}$",
        r"[A-Za-z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Da-d]$",
        r"[A-Za-z]{2} ?\d{7}$|[A-Za-z]{2}-\d{3}-\d{4}$",
    )
]
#: Number of digits beyond which no form of a phone or identity number is looked for; such candidates have a vote against them.
_MOST_DIGITS = 24
_SHAPES = ((re.compile(rf"[{UPPER}]+"), "A"), (re.compile(r"[^\W\dA_]+"), "a"), (re.compile(r"\d+"), "9"))


def _shape(s: str) -> str:
    for pattern, sign in _SHAPES:
        s = pattern.sub(sign, s)
    return s[:24]


_memo: dict[str, int] = {}


def _slot(feature: str) -> int:
    """Place of a feature in the weight vector."""
    slot = _memo.get(feature)
    if slot is None:
        if len(_memo) >= 500_000:
            _memo.clear()
        slot = _memo[feature] = xxhash.xxh64_intdigest(feature) % DIMENSIONS
    return slot


@lru_cache(maxsize=10_000)
def _vote_slots(kind: str, votes: tuple[int, ...]) -> list[int]:
    return [_slot(f"{kind}|bias"), *(_slot(f"{kind}|v{i}={v}") for i, v in enumerate(votes))]


class _Reader:
    """The candidates of one plain text, kind by kind."""

    def __init__(self, text: str, names: Gazetteer) -> None:
        self.text, self.names = text, names
        self.out: list[Candidate] = []
        self._title = (-1, False)

    def journal(self, end: int) -> bool:
        """Whether shortened words and a number follow. A row of such words is read once, however many names end in it."""
        if end >= self._title[0]:
            row = _SHORT.match(self.text, end)
            if not row:
                return False
            self._title = (row.end(), bool(_VOLUME.match(self.text, row.end())))
        return self._title[1]

    def before(self, start: int, n: int = 4) -> list[str]:
        """The last n words before start, nearest first, in lower case."""
        width = 15 * n
        while True:  # the first word of a stretch may have lost its head, so one more is wanted
            low = max(0, start - width)
            found = _TEXT_WORD.findall(self.text, low, start)
            if len(found) > n or low == 0:
                return [w.lower() for w in found[: -n - 1 : -1]]
            width *= 4

    def after(self, end: int, n: int = 2) -> list[str]:
        """The first n words from end on, in lower case."""
        return [m.group().lower() for m in islice(_TEXT_WORD.finditer(self.text, end), n)]

    def add(self, kind: str, start: int, end: int, votes: tuple[int, ...], features: Sequence[str], before: list[str] | None = None, after: list[str] | None = None, given: str | None = None, tail: str | None = None) -> None:
        before = self.before(start) if before is None else before
        after = self.after(end, 1) if after is None else after
        if kind in _CONTEXT:
            votes = (*votes, *_context(kind, before))
        slots = [*_vote_slots(kind, votes), _slot(f"{kind}|before={before[0] if before else ''}"), _slot(f"{kind}|next={after[0] if after else ''}")]
        slots += [_slot(f"{kind}|{x}") for x in features]
        self.out.append(Candidate(kind, start, end, votes, slots, given, tail))

    def emails(self) -> None:
        text, names, done = self.text, self.names, 0
        for sign in _SIGN.finditer(text):
            at, behind = sign.span()
            if text[at] in "aA":  # "x at lab dot org": the spaces belong to the sign
                behind += 1
            elif behind < len(text) and text[behind].isspace():
                behind += 1
            end = at - 1 if at > done and text[at - 1].isspace() else at
            low = end
            while low > done and (text[low - 1].isalnum() or text[low - 1] in "_.+%-"):
                low -= 1
            while low < end and not (text[low].isalnum() or text[low] == "_"):
                low += 1
            host = _HOST.match(text, behind)
            if low == end or not host:
                continue
            labels = _LABELS.findall(_DOTS.sub(".", host.group()))
            top, known = labels[-1], any(names.is_given(x) or names.is_surname(x) for x in re.split(r"[._+\-\d]+", text[low:end]))
            named = top.isalpha() and len(top) > 1
            done = host.end()
            self.add("email", low, done, (_vote(len(labels) > 1 and named, True), _vote(any(c.isalpha() for x in labels[:-1] for c in x), not named), _vote(known)), (f"top={top.lower()}",))

    def phones(self) -> None:
        for m in _PHONE.finditer(self.text):
            start, end = m.span()
            if end - start < 7:
                continue
            s = m.group()
            digits = sum(map(str.isdigit, s))
            if digits < 7:
                continue
            short = digits <= _MOST_DIGITS
            form = next((i for i, p in enumerate(_PHONE_FORMS) if p.match(s)), -1) if short else -1
            own_id = short and any(p.match(s) for p in _ID_FORMS)
            self.add("phone", start, end, (_vote(form >= 0, True), _vote(9 <= digits <= 15 and not own_id, not 8 <= digits <= 15 or own_id), _vote(s[0] in "+(")), (f"form={form}", f"shape={_shape(s)}"))

    def id_numbers(self) -> bool:
        """Identity numbers, by the runs of digits; whether any run stands where a German house number does."""
        text, found, house = self.text, [], False
        for m in _RUN.finditer(text):
            at = m.start()
            head = text[max(0, at - 9) : at]
            if head[-1:] == " " and head[:-1].lower().endswith(_STREET_ENDS):
                house = True
            hit = None
            lead = _ID_LEAD.search(text, max(0, at - 4), at) if head[-1:].isalpha() or head[-2:-1].isalpha() else None
            if lead:
                hit = _ID_LETTERS.match(text, lead.start())
            if not hit and not (head and (head[-1].isalnum() or head[-1] in "_@/.-")):
                hit = _ID_DIGITS.match(text, at)
            if hit:
                found.append(hit)
        done = -1
        for m in sorted(found, key=lambda m: m.start()):
            if m.start() < done:
                continue
            done, s = m.end(), m.group()
            form = next((i for i, p in enumerate(_ID_FORMS) if p.match(s)), -1)
            few = sum(map(str.isdigit, s)) < 6 or bool(re.match(r"\d{4}-\d{4}$|\d{3}/\d{4}$", s))
            self.add("id_number", m.start(), m.end(), (_vote(form >= 0, True), _vote(form in (0, 3), few)), (f"form={form}", f"head={re.match('[A-Za-z]*', s)[0].upper()}", f"shape={_shape(s)}"))
        return house

    def addresses(self, house: bool) -> None:
        low = self.text.lower()
        calle = any(w in low for w in _CALLES)
        for i, pattern in enumerate(_STREETS):
            if i == 2 and not calle or i == 3 and not house:
                continue
            for m in pattern.finditer(self.text):
                post = bool(re.search(r"\b\d{4,5}\b", m.group()))
                first = re.match(r"\d+[A-Za-z]?,? (\w+)", m.group())
                common = bool(first) and first.group(1).lower() in _NOT_GIVEN
                self.add("address", m.start(), m.end(), (_vote(True), _vote(post), _vote(not common, common)), (f"street={i}",))

    def _inverse(self, tokens: list[tuple[int, int]], i: int) -> tuple[int, int] | None:
        """Place of the given name behind "Surname, " at token i, if there is one."""
        text, n = self.text, len(tokens)
        if i + 1 >= n or text[tokens[i][1] : tokens[i + 1][0]] != ", ":
            return None
        start, end = tokens[i + 1]
        if text[end - 1] != "." and i + 2 < n and text[end : tokens[i + 2][0]] == " " and text[tokens[i + 2][1] - 1] == "." and not self._runs_on(tokens[i + 2][1]):
            return start, tokens[i + 2][1]
        if self._runs_on(end):  # all but the part that runs on into something else
            end = max(text.rfind(" ", start, end), text.rfind("-", start, end))
        return (start, end) if end > start else None

    def _runs_on(self, end: int) -> bool:
        after = self.text[end : end + 1]
        return after.isalnum() or after in ("_", "@")

    def person_names(self) -> None:
        text, names = self.text, self.names
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        n, i, done = len(tokens), 0, 0
        while i < n:
            at, given_end = tokens[i]
            is_word = text[given_end - 1] != "."
            start, inverse, given = at, False, ""
            if is_word and (back := self._inverse(tokens, i)):
                inverse, sur_at = True, i
                given, end = text[back[0] : back[1]], back[1]
                part = _PART_BEFORE.search(text, max(done, at - 8), at)
                if part:
                    start = part.start()
            else:
                sur_at = i + 1
                if is_word and sur_at + 1 < n and text[given_end : tokens[sur_at][0]] == " " and text[tokens[sur_at][1] - 1] == ".":
                    given_end, sur_at = tokens[sur_at][1], sur_at + 1
                if sur_at >= n or text[tokens[sur_at][1] - 1] == "." or text[given_end : tokens[sur_at][0]] not in _GAPS:
                    i += 1
                    continue
                given, end = text[at:given_end], tokens[sur_at][1]
            bare = text[tokens[sur_at][0] : tokens[sur_at][1]]
            known, alike = names.is_surname(bare), names.like_surname(bare)
            word = given.split(" ")[0]
            start_given = word.casefold()
            unlisted = not (known or alike)
            if not inverse and " " in given and start_given in _NOT_GIVEN:  # "Mme P. Surname"
                i += 1
                continue
            initials = given[1:2] == "."
            is_given = names.is_given(word)
            unlikely = not initials and (start_given in _NOT_GIVEN or names.like_surname(word) or (inverse and not is_given))
            if not unlisted and not initials and not inverse and unlikely and not is_given and self._inverse(tokens, sur_at):
                i = sur_at  # "The Surname": the surname opens "Surname, J."
                continue
            after, before = self.after(end), self.before(start)
            grouped = bool(after) and after[0] in _GROUPS and not (after[0] == "et" and (len(after) < 2 or not after[1].startswith("al")))
            joined = text[end : end + 1] in ("–", "@") or (text[end : end + 1] == "-" and text[end + 1 : end + 2].isalpha())
            title = bool(before) and before[0] in _TITLES
            person = bool(before) and before[0] in _PERSONS
            if unlisted:
                common = bare.casefold() in _NOT_GIVEN or bare.casefold() in _GROUPS
                journal = initials and not inverse and self.journal(end)
                is_given = is_given and not (before and before[0] in _ARTICLES)  # "the Rose Garden"
                unlikely = unlikely or common or journal or not (is_given or initials or title or person)
                joined = joined or common or journal
                initials = initials and not journal
            votes = (
                UNLISTED if unlisted else _vote(known),
                UNLISTED if unlisted else _vote(alike, True),
                _vote(is_given or initials, start_given in _NOT_GIVEN),
                _vote(False, unlikely),
                _vote((title or unlisted and person) and not joined, (grouped and not is_given and not initials) or joined),
            )
            folded = bare.casefold()
            kept = "I" if initials else start_given if is_given or start_given in _NOT_GIVEN else "other"
            features = (f"tail={folded[-3:]}", f"tail4={folded[-4:]}", f"head={folded[:3]}", f"given={kept}", f"inverse={inverse}", f"caps={bare.isupper()}")
            open_ = not initials and votes[2] == 0
            self.add("name", start, end, votes, features, before, after, start_given if open_ else None, folded[-4:] if open_ and not inverse else None)
            # a surname that turns out to be none of this given name may still belong to the next one
            if unlisted:
                i = i + 1 if inverse or is_word else sur_at
            elif not unlikely or is_given or inverse:
                i = bisect_left(tokens, (end, end))
                done = end
            else:
                i = sur_at


def candidates(text: str, names: Gazetteer) -> list[Candidate]:
    """Candidate places of all kinds in a plain text, with votes and features.

    Names with a surname that no list has are proposed too and may overlap others; the rest of a kind don't overlap.
    """
    read = _Reader(text, names)
    read.emails()
    read.phones()
    read.addresses(read.id_numbers())
    read.person_names()
    return read.out


# --- estimation ---------------------------------------------------------------------------------------------------


def estimate(patterns: Sequence[tuple[tuple[int, ...], int]], rounds: int = 60, prior: float = 8.0) -> dict[tuple[int, ...], float]:
    """Posterior of each pattern of votes to be a true place, by expectation-maximisation over the patterns' counts.

    A vote of UNLISTED says nothing for or against. Labelers are independent given the truth; each has, per class, a probability of every vote, with a prior that makes
    it somewhat better than chance. Starts from the balance of votes.
    """
    votes = np.array([p for p, _ in patterns], np.int64)
    n = np.array([c for _, c in patterns], float)
    n = n / n.sum() * max(1000.0, min(n.sum(), 1e6))  # the prior weighs as much in a corpus of any size
    posterior = 1 / (1 + np.exp(-1.5 * np.where(votes == UNLISTED, 0, votes).sum(axis=1)))
    hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    lean = np.array([[0.2, 1.0, 1.8], [1.8, 1.0, 0.2]]) * prior
    for _ in range(rounds):
        rates = []
        for c, weight in enumerate((n * posterior, n * (1 - posterior))):
            table = np.einsum("p,plv->lv", weight, hot) + lean[c]
            rates.append(np.log(table / table.sum(axis=1, keepdims=True)))
        share = np.clip((n * posterior).sum() / n.sum(), 0.02, 0.98)
        odds = np.log(share / (1 - share)) + np.einsum("plv,lv->p", hot, rates[0] - rates[1])
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return {p: float(x) for (p, _), x in zip(patterns, posterior, strict=True)}


def train(slots: Sequence[Sequence[int]], labels: Sequence[float], rounds: int = 300, rate: float = 0.5, decay: float = 1e-3) -> np.ndarray:
    """Weights of a logistic classifier for soft labels, by full-batch gradient steps with per-weight scaling."""
    flat = np.array([s for row in slots for s in row], np.int64)
    row = np.repeat(np.arange(len(slots)), [len(r) for r in slots])
    y, w, seen = np.array(labels, float), np.zeros(DIMENSIONS), np.full(DIMENSIONS, 1e-8)
    if not len(y):
        return w
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[flat], len(y)), -30, 30)))
        gradient = np.bincount(flat, (p - y)[row], DIMENSIONS) / len(y) + decay * w
        seen += gradient**2
        w -= rate * gradient / np.sqrt(seen)
    return w


@dataclass(frozen=True)
class Model:
    """Weights of the span classifier (a zero for no feature behind them), the gazetteer, and given names that the corpus showed in front of surnames.

    learned is None where they are too many to be sent: they were joined to the candidates then.
    """

    names: Gazetteer
    weights: np.ndarray
    learned: frozenset[str] | None = frozenset()

    def accepts(self, kinds: np.ndarray, votes: np.ndarray, slots: np.ndarray, given: Sequence[str | None]) -> np.ndarray:
        """Which of the candidates are places: kinds as numbers, coded votes, a row of slots each, given names to be looked up."""
        score = self.weights[slots].sum(axis=1)
        for i in np.flatnonzero(kinds == KINDS.index("name")).tolist():
            if given[i] is not None and (self.learned is None or given[i] in self.learned):
                old = uncoded(int(votes[i]))
                score[i] += self._weight(2, 1) - self._weight(2, old[2]) + self._weight(3, 0) - self._weight(3, old[3])
        return score > 0

    def _weight(self, labeler: int, vote: int) -> float:
        return float(self.weights[_slot(f"name|v{labeler}={vote}")])


def resolve(spans: Iterable[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Accepted (start, end, kind) without overlaps, in order: kinds before later kinds, then longer places first."""
    kept: list[tuple[int, int, str]] = []
    for s in sorted(spans, key=lambda s: (_RANK[s[2]], s[0] - s[1], s[0])):
        i = bisect_left(kept, s)
        if (i == 0 or kept[i - 1][1] <= s[0]) and (i == len(kept) or s[1] <= kept[i][0]):
            kept.insert(i, s)
    return kept


_RANK = {k: i for i, k in enumerate(("email", "address", "id_number", "phone", "name"))}


def replaced(text: str, spans: Iterable[tuple[int, int, str]]) -> str:
    """The text with [KIND] in each of the spans, which are in order and don't overlap."""
    out, done = [], 0
    for a, b, kind in spans:
        out += [text[done:a], f"[{kind.upper()}]"]
        done = b
    return "".join([*out, text[done:]])


# --- operators ----------------------------------------------------------------------------------------------------

#: One row per text, its candidates in parallel arrays; given is set where the given name is open, tail where it may be learned from.
_FOUND = "rid bigint, doc_id bigint, text string, kind array<tinyint>, start array<int>, end array<int>, votes array<int>, slots array<array<smallint>>, given array<string>, tail array<string>"
#: Votes of -1, 0, 1 and UNLISTED as digits of a number of this base.
_BASE = 4


@lru_cache(maxsize=10_000)
def coded(votes: tuple[int, ...]) -> int:
    """Votes as one number."""
    code = 1
    for v in reversed(votes):
        code = code * _BASE + v + 1
    return code


def uncoded(code: int) -> tuple[int, ...]:
    """The votes of coded."""
    out = []
    while code > 1:
        code, v = divmod(code, _BASE)
        out.append(v - 1)
    return tuple(out)


def gazetteer(names: DataFrame, name: str = "name_part", kind: str = "part_kind") -> Gazetteer:
    """The gazetteer of a table of names; kinds are given and surname, other kinds and NULLs are left out."""
    rows = names.select(F.col(name).cast("string"), F.col(kind).cast("string")).where(F.col(name).isNotNull()).distinct().limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names; they are sent to every task")
    return Gazetteer((n for n, k in rows if k == "given"), (n for n, k in rows if k == "surname"))


def pii_candidates(docs: DataFrame, names: Gazetteer, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """The candidates of every text that has any, their places in code points of the text as it is.

    With keep_text every text comes out, those without candidates, empty and NULL ones too.
    """
    sent = docs.sparkSession.sparkContext.broadcast(names)

    def propose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                rows = _Rows(keep_text)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    number += 1
                    read = plain(t) if t else None
                    rows.put(number, i, t, read, candidates(read.text, sent.value) if read else [])
                yield rows.batch()

    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return spread(read if keep_text else read.where("text <> ''")).mapInArrow(propose, _FOUND)


class _Rows:
    """Columns of _FOUND, filled row by row."""

    def __init__(self, keep_text: bool) -> None:
        self.keep_text = keep_text
        self.rid: list[int] = []
        self.doc_id: list[int | None] = []
        self.text: list[str | None] = []
        self.ends = array("i", [0])
        self.numbers = {n: array("i") for n in ("kind", "start", "end", "votes", "slots")}
        self.slot_ends = array("i", [0])
        self.given: list[str | None] = []
        self.tail: list[str | None] = []

    def put(self, rid: int, doc_id: int | None, text: str | None, read: Plain | None, own: list[Candidate]) -> None:
        if not own and not self.keep_text:
            return
        self.rid.append(rid)
        self.doc_id.append(doc_id)
        self.text.append(text if self.keep_text else None)
        to = self.numbers
        for kind, start, end, votes, slots, given, tail in own:
            to["kind"].append(_NUMBER[kind])
            to["start"].append(read.source(start))
            to["end"].append(read.source_end(end))
            to["votes"].append(coded(votes))
            to["slots"].extend(slots)
            self.slot_ends.append(len(to["slots"]))
            self.given.append(given)
            self.tail.append(tail)
        self.ends.append(len(self.given))

    def batch(self) -> pa.RecordBatch:
        flat: dict[str, pa.Array] = {n: pa.array(np.frombuffer(v, np.int32) if len(v) else [], pa.int32()) for n, v in self.numbers.items()}
        flat |= {"kind": flat["kind"].cast(pa.int8()), "slots": pa.ListArray.from_arrays(pa.array(self.slot_ends, pa.int32()), flat["slots"].cast(pa.int16()))}
        flat |= {"given": pa.array(self.given, pa.string()), "tail": pa.array(self.tail, pa.string())}
        ends = pa.array(self.ends, pa.int32())
        own = [pa.array(self.rid, pa.int64()), pa.array(self.doc_id, pa.int64()), pa.array(self.text, pa.string())]
        return pa.RecordBatch.from_arrays([*own, *(pa.ListArray.from_arrays(ends, v) for v in flat.values())], ["rid", "doc_id", "text", *flat])


_NUMBER = {k: i for i, k in enumerate(KINDS)}


def fit(found: DataFrame, names: Gazetteer, sample: int = SAMPLE_PER_PATTERN, max_names: int = MAX_NAMES) -> tuple[Model, DataFrame]:
    """The model for candidates found in the whole corpus: reliabilities from all vote counts, weights from a sample; and the candidates to decide on.

    The vote patterns are at most 4 to the number of a kind's labelers. The sample takes a share of each pattern's
    candidates by their hash, so that about `sample` of each are expected; its size is bounded by patterns x sample.
    Given names learned are sent to the tasks, or, of more than max_names, joined: then given is left only where it was learned.
    """
    each = found.select("rid", F.explode(F.arrays_zip("kind", "votes", "start", "slots")).alias("c")).select("rid", "c.*")
    counted = [(KINDS[r.kind], r.votes, r.n) for r in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()]
    truth: dict[tuple[str, int], float] = {}
    for kind in KINDS:
        own = sorted((uncoded(v), n) for k, v, n in counted if k == kind)
        if own:
            truth |= {(kind, coded(v)): p for v, p in estimate(own).items()}
    if not truth:
        return Model(names, np.zeros(DIMENSIONS + 1)), found
    spark = found.sparkSession
    share = F.broadcast(spark.createDataFrame([(KINDS.index(k), v, min(1.0, sample / n)) for k, v, n in counted], "kind tinyint, votes int, share double"))
    drawn = each.join(share, ["kind", "votes"]).where(F.pmod(F.xxhash64("rid", "start", "kind"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    rows = sorted((r.kind, r.votes, tuple(r.slots)) for r in drawn.select("kind", "votes", "slots").collect())
    weights = np.append(train([s for _, _, s in rows], [truth[KINDS[k], v] for k, v, _ in rows]), 0.0)
    learned = _learned(found)
    few = [r.g for r in learned.limit(max_names + 1).collect()]
    if len(few) <= max_names:
        return Model(names, weights, frozenset(few)), found
    return Model(names, weights, None), _only_learned(found, learned)


def _learned(found: DataFrame) -> DataFrame:
    """(g): words in no list that are given names by the pairs they open in the whole corpus, candidates without any surname known included.

    A share of at least one half, at the lower end of its interval (Wilson's) for CERTAINTY, must have a surname that is
    listed or alike and nothing against it. A rate, so that it says the same in corpora of any size once a word is seen often enough.
    """
    pairs = found.select(F.explode(F.arrays_zip("kind", "votes", "given", "tail")).alias("c")).where("c.tail IS NOT NULL").select("c.*")
    vote = lambda i: F.pmod(F.floor(F.col("votes") / _BASE**i), F.lit(_BASE)) - 1
    good = (vote(0) != UNLISTED) & (vote(3) == 0) & (vote(4) >= 0)
    counted = pairs.groupBy(F.col("given").alias("g")).agg(F.count(F.lit(1)).alias("n"), F.count_if(good).alias("k"))
    return counted.where(_lower_bound(F.col("k"), F.col("n")) >= 0.5).select("g")


def _lower_bound(k: Column, n: Column, z: float = CERTAINTY) -> Column:
    """Lower end of Wilson's interval of a share k / n."""
    p = k / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def _only_learned(found: DataFrame, learned: DataFrame) -> DataFrame:
    """found, with given kept only where it is among the learned names; only rows' numbers and open given names are shuffled before."""
    open_ = found.select("rid", F.posexplode("given").alias("at", "g")).where("g IS NOT NULL")
    kept = open_.join(learned, "g", "left_semi").groupBy("rid").agg(F.collect_set("at").alias("__kept"))
    held = F.coalesce("__kept", F.array().cast("array<int>"))
    given = F.transform("given", lambda g, i: F.when(F.array_contains(held, i), g))
    return found.join(kept, "rid", "left").withColumn("given", given).drop("__kept")


def _accepted(found: DataFrame, model: Model, finish, schema: str, columns: Sequence[str]) -> DataFrame:
    """finish(doc_ids, texts, places of each row) on every batch of found."""
    sent = found.sparkSession.sparkContext.broadcast(model)

    def decide(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            ends = np.asarray(col["kind"].offsets)  # offsets of a slice count from its parent's first value
            cut = slice(int(ends[0]), int(ends[-1]))
            flat = {n: col[n].values[cut] if n == "given" else np.asarray(col[n].values[cut]) for n in ("kind", "start", "end", "votes", "given")}
            lists = col["slots"].values[cut]
            slots = np.full((len(lists), SLOTS), DIMENSIONS, np.int32)
            sizes = np.diff(np.asarray(lists.offsets))
            slots[np.arange(SLOTS) < sizes[:, None]] = np.asarray(lists.flatten())
            yes = sent.value.accepts(flat["kind"], flat["votes"], slots, flat["given"].to_pylist())
            places = []
            taken = np.flatnonzero(yes)
            row = np.searchsorted(ends - ends[0], taken, "right") - 1
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            spans = list(zip(flat["start"][taken].tolist(), flat["end"][taken].tolist(), [KINDS[k] for k in flat["kind"][taken].tolist()], strict=True))
            for a, b in pairwise(first.tolist()):
                places.append(resolve(set(spans[a:b])) if b - a > 1 else spans[a:b])
            yield finish(col["doc_id"], col["text"] if "text" in col else None, places)

    return found.select(*columns, "kind", "start", "end", "votes", "slots", "given").mapInArrow(decide, schema)


def pii_places(docs: DataFrame, names: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, pii_kind, span_start, span_end): each place, in code points of the text as it is.

    NULL and empty texts have none. Repeated texts and ids each have their own places. Without names in the
    gazetteer names have nothing but titles, initials and context to speak for them. Empty docs give no rows; other columns are not read.
    """
    known = gazetteer(names)
    model, found = fit(materialize(pii_candidates(docs, known, doc_id, text), "pii-candidates"), known)

    def finish(ids: pa.Array, _: pa.Array | None, places: list[list[tuple[int, int, str]]]) -> pa.RecordBatch:
        out = [(i, kind, a, b) for i, own in zip(ids.to_pylist(), places, strict=True) for a, b, kind in own]
        columns = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.int32()), strict=True)], ["doc_id", "pii_kind", "span_start", "span_end"])

    return _accepted(found, model, finish, "doc_id bigint, pii_kind string, span_start int, span_end int", ["doc_id"])


def redact(docs: DataFrame, names: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_places): each text with a typed placeholder, such as [EMAIL], in each place, the rest unchanged.

    NULL and empty texts stay as they are. Texts are written to the shared folder with their candidates, so that the
    patterns run once on each; the model is fitted on the same docs.
    """
    known = gazetteer(names)
    model, found = fit(materialize(pii_candidates(docs, known, doc_id, text, keep_text=True), "pii-candidates"), known)

    def finish(ids: pa.Array, texts: pa.Array | None, places: list[list[tuple[int, int, str]]]) -> pa.RecordBatch:
        written = [replaced(t, own) if own else t for t, own in zip(texts.to_pylist(), places, strict=True)]
        return pa.RecordBatch.from_arrays([ids, pa.array(written, pa.string()), pa.array(map(len, places), pa.int32())], ["doc_id", "text", "n_places"])

    return _accepted(found, model, finish, "doc_id bigint, text string, n_places int", ["doc_id", "text"])
