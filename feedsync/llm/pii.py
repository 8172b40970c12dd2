"""Personal data by patterns and a linear-chain conditional random field (operator 12).

Four kinds are marked: ``email``, ``ip``, ``card`` and ``phone``.  The base spans are
those of the contract's patterns, found in one linear pass each, also over very long
runs of digits or letters.  The method adds spans that no pattern has, such as
``jane (at) mail (dot) org`` or a telephone number without ``+``.

*Model.*  Words are runs without ASCII white space, labelled O, B-kind or I-kind.  A
word's features are its shape (letters collapsed, digit runs by length, punctuation
kept), parts of it, and the word itself if it stands near a span in the training
table; the score of a position adds the weights of the word before, the word and the
word after, and a weight for each pair of neighbouring labels.  ``train`` maximises the
penalised likelihood by forward-backward over a small labelled table (a documented
parameter, :data:`TABLE` by default; some 100 sentences) on the driver.

*Decoding* is Viterbi over whole texts in numpy batches.  Weights of label pairs are
kept within ``PAIR_LIMIT``, so a word whose score for O leads by more than any two
label pairs can gain is O on every best path; the text is cut there, exactly, and only
the segments between go through the recursion, batched by length.

*Check.*  A span that the model adds must be of its kind after normalisation: an
address of the base pattern, four parts up to 255, 13 to 19 digits passing Luhn, or 7
to 15 digits.  A span that meets a base span of any kind is not added; base spans stay.

Defined results: a null text is empty and has no spans; a null id stays null; rows that
repeat an id each give a row; other columns are not read; an empty table gives an empty
result.  Texts are read in slices of a few MB and cut at white space, so memory stays
bounded by the longest run without white space and the words of a slice.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.llm.common import BoundedCache, slices, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
PAIR_LIMIT = 2.0
STEPS = 250
PENALTY = 0.02
PIECE = 1 << 20  # characters of a text whose words are held at a time
SHAPE = 32  # symbols of a shape that count

RESULT = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)

# ------------------------------------------------------------------ base patterns

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_SPACED = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_OTHER = re.compile("[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """An address ends its run of local characters at an ``@``, so each ``@`` is tried
    once, with the characters before it down to the last match."""
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        after = domain.end() if domain else at + 1
        if domain:
            found.append((start, after))
        at = text.find("@", after)
    return found


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def ips(text: str) -> list[tuple[int, int]]:
    """A dotted chain of digit runs holds one match for each four parts."""
    found = []
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".") if m.end() - m.start() > 6 else ()
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(map(_octet, four)):
                found.append((at, at + size))
            at += size + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += v if i % 2 == 0 else 2 * v - 9 * (v > 4)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _SPACED.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _OTHER.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_OTHER.sub("", m.group())) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """By kind as listed, then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, find in (("ip", ips), ("card", cards), ("phone", phones)):
            out += [(kind, s, e) for s, e in find(text)]
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# ------------------------------------------------------------------ features

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_GAP = re.compile(r"[\x20\x09-\x0D]")
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile("[0-9]+")
_REPEAT = re.compile(r"([^\w\s])\1+")
_EDGE = ".,;:!?\"'()[]<>{}*#$%&|"


def _digit_run(m: re.Match) -> str:
    n = m.end() - m.start()
    return "9" * n if n <= 4 else "9" * 5 if n <= 8 else "9" * 6 if n <= 12 else "9" * 7 if n <= 19 else "9" * 8


def core(word: str) -> str:
    return word.strip(_EDGE).lower()


def features(word: str, lexicon: frozenset[str]) -> tuple[str, ...]:
    """The features of one word, whatever its place."""
    inner = core(word)
    if inner.isalpha():
        return (f"w={inner}" if inner in lexicon else "w=", "alpha")
    shape = _REPEAT.sub(r"\1", _DIGITS.sub(_digit_run, _LETTERS.sub("x", word)))[:SHAPE]
    n = sum(map(len, _DIGITS.findall(word)))
    size = 0 if n == 0 else 1 if n <= 2 else 2 if n <= 4 else 3 if n <= 6 else 4 if n <= 8 else 5 if n <= 12 else 6
    out = [f"s={shape}", f"c={shape.strip(_EDGE)}", f"n={size}", f"dots={min(shape.count('.'), 4)}"]
    out += [f"has{c}" for c in "@+-/(=:" if c in shape]
    out += [f"first={shape[:1]}", "letters" if "x" in shape else "plain"]
    if "x" in shape and n:
        out.append("mixed")
    if word.lower() in lexicon:
        out.append(f"w={word.lower()}")
    return tuple(out)


# ------------------------------------------------------------------ the training table

# Sentences in four languages; a span is written [[kind text]].  Numbers that are no
# personal data (dates, prices, versions, references) stand unmarked.
TABLE = (
    "please call [[phone 555-0123]] before noon",
    "my number is [[phone (030) 5550142]] and I am in today",
    "Phone: [[phone 020 7946 0958]] or write to [[email jane.roe@mail.example.org]]",
    "tel. [[phone 01632 960 983]] , ask for the desk",
    "you can reach her on [[phone 415-555-0198]] after six",
    "call [[phone (212) 555-0187]] to book a table",
    "ring me at [[phone +44 20 7946 0018]] tonight",
    "the hotline [[phone +1 (017) 555-7713]] is open",
    "his mobile [[phone 0171 5550 133]] was off",
    "fax [[phone 030/5550177]] works again",
    "mobile: [[phone 07700 900 461]] for the driver",
    "contact [[phone 555 0164]] for help",
    "Telefon [[phone 089 5550 122]] ab neun Uhr",
    "ruf mich unter [[phone 0221 555 0199]] an",
    "erreichbar unter der Nummer [[phone 040/555 01 88]] bis Freitag",
    "Handy [[phone 0160-5550134]] oder Mail an [[email max.muster@post.example.de]]",
    "appelez le [[phone 01 99 00 12 34]] demain",
    "mon portable est le [[phone 06 39 98 11 22]] merci",
    "tél. [[phone 04 65 71 33 44]] de neuf à midi",
    "llame al [[phone 91 555 01 47]] por la tarde",
    "mi teléfono es [[phone 612 555 098]] gracias",
    "móvil [[phone 655-550-121]] a cualquier hora",
    "write to [[email jane (at) example (dot) org]] for details",
    "mail [[email john.doe (at) mail.example.com]] about it",
    "reach me by email: [[email r.smith [at] example [dot] net]] thanks",
    "my address is [[email ann at mail dot example dot com]] for now",
    "send it to [[email bob_77 AT example DOT org]] today",
    "schreib an [[email erika[at]beispiel.example.de]] bitte",
    "E-Mail: [[email kontakt(at)verein.example.de]] oder anrufen",
    "écrivez à [[email luc (at) courriel.example.fr]] svp",
    "correo: [[email ana [arroba] correo.example.es]] para dudas",
    "contact [[email sales@shop.example.com]] with questions",
    "from [[email th.92@mail6.example.com]] we got a letter",
    "ask [[email info(at)example.net]] or visit us",
    "the server [[ip 10[.]0[.]12[.]7]] was seen again",
    "blocked host [[ip 192[.]168[.]1[.]20]] at the gate",
    "traffic from [[ip 203 . 0 . 113 . 9]] stopped",
    "connect to [[ip 198(.)51(.)100(.)23]] on port 22",
    "login from ip [[ip 144.137.247.239]] last night",
    "address [[ip 172.16.0.3]] answered",
    "adresse [[ip 203[.]0[.]113[.]77]] bloquée",
    "card number [[card 4111.1111.1111.1111]] expires soon",
    "paid with card [[card 5500/0000/0000/0004]] yesterday",
    "credit card: [[card 3400_000000_00009]] please",
    "Karte [[card 4012.8888.8888.1881]] wurde belastet",
    "ma carte [[card 4222/2222/2222/2220/008]] est volée",
    "tarjeta [[card 5105.1051.0510.5100]] caducada",
    "the card [[card 4111 1111 1111 1111]] was declined",
    "charged to [[card 4000056655665556]] in May",
    "the meeting is on 2024-05-17 at 12:30 in room 4",
    "am 17.05.2024 um 9 Uhr in Raum 12",
    "le 17/05/2024 à 14h30 au 3 rue du Lac",
    "el 5 de mayo de 1998 en la sala 7",
    "version 2.0.1 replaces 1.9.12 and 1.9.11",
    "licensed under the Apache License, Version 2.0.",
    "see pages 34-36 and 120-145 of volume 3",
    "the price rose from 1,299.00 to 1,499.50 dollars",
    "it cost 12.500,00 Euro im Jahr 2019",
    "between 1990 and 1999 some 250 000 people moved",
    "order 2024-0017 was shipped with 3 parts",
    "invoice INV-20240017 of 03.04.2021 is open",
    "ISBN 978-3-16-148410-0 is out of print",
    "the score was 3-2 after 90 minutes",
    "add 3 + 4 and 5 - 2 to get 10",
    "about 45 % of 1200 users answered",
    "row 12 15 18 22 31 40 of the table",
    "values 0.12 0.45 0.98 1.20 in column 2",
    "token = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\" of the job",
    "commit 7a3f9c2 fixes issue 4821 in build 20240312",
    "serial no. 88412003 of model X-200",
    "part 4821-A fits the 2015 model",
    "section 4.2.1.3 of the manual covers it",
    "it is 48.8566 north and 2.3522 east",
    "the ratio 16:9 and the size 1920x1080",
    "from 8:00 to 17:30 on weekdays",
    "chapter 7, verse 12 to 19",
    "100 000 copies were sold in 2003",
    "the number 5927243074273351 means nothing",
    "reference 9807915762804491 is closed",
    "population 3 145 000 in 2011 and 2 980 000 in 1991",
    "we met at noon and had tea at home",
    "look at the dot on the map at the end",
    "a point (at) which the line ends (dot)",
    "he is at work and she is at school",
    "the house at the lake was sold",
    "point dot dash and a dot again",
    "please call me when you are back",
    "my phone is broken and the card is lost",
    "the address of the house is not known",
    "Telefon und Karte sind weg",
    "le numéro de la rue est effacé",
    "el correo no llega a casa",
    "users @home and @work are tags",
    "email me about the phone number of the shop",
    "die Nummer 4 lebt und die Nummer 12 auch",
    "in 1848 , 1871 und 1918 war es so",
    "the of and to in a is that it was for on are as with",
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se",
    "de la que el en y a los se del las un por con no una su para es al lo como más",
    "thing onedth whed ereden ingnt , erble hent or ount. Thre blee ing",
    "A. B. C. and D. are names ; so are E! and F?",
    "- item | cell | cell2 | *** ### $$$ &&& %%%",
    "\"quoted\" (bracket) [square] {curly} <tag> end",
)
_MARK = re.compile(r"\[\[(\w+) (.*?)\]\](?=[\s.,;:!?]|$)")


def parse(sentence: str) -> tuple[list[str], list[int]]:
    """(words, labels) of a marked sentence."""
    words, labels, at = [], [], 0
    for m in [*_MARK.finditer(sentence), None]:
        plain = WORD.findall(sentence[at : m.start()] if m else sentence[at:])
        words += plain
        labels += [0] * len(plain)
        if m:
            inside = WORD.findall(m.group(2))
            first = 1 + 2 * KINDS.index(m.group(1))
            words += inside
            labels += [first] + [first + 1] * (len(inside) - 1)
            at = m.end()
    return words, labels


# ------------------------------------------------------------------ the model


@dataclass
class Model:
    """Weights by feature and place (before, here, after), and of label pairs."""

    lexicon: frozenset[str]
    index: dict[str, int]
    weights: np.ndarray  # [3, features, labels]
    pairs: np.ndarray  # [labels, labels]

    def scores(self, found: tuple[str, ...]) -> np.ndarray:
        """[3, labels]: what a word with these features adds to the next place, to its
        own, and to the one before."""
        known = [self.index[f] for f in found if f in self.index]
        return self.weights[:, known].sum(1) if known else np.zeros((3, len(LABELS)))

    def gains(self) -> np.ndarray:
        """For each label, the most that the pairs around it can win over O there."""
        t, ends = self.pairs, np.zeros(1)
        enter = t - t[:, :1]  # [a, y]: a then y instead of a then O
        leave = t - t[:1]  # [y, b]
        into = np.maximum(enter.max(0), ends)
        out = np.maximum(leave.max(1), ends)
        return into + out


def likelihood(scores: np.ndarray, pairs: np.ndarray, mask: np.ndarray, gold: np.ndarray):
    """(log likelihood, its gradient by scores, by pairs) of padded sequences
    [sequences, places, labels], by scaled forward-backward."""
    n, size, k = scores.shape
    top = scores.max(2, keepdims=True)
    here, step = np.exp(scores - top), np.exp(pairs)
    forward, backward, scale = np.zeros((n, size, k)), np.ones((n, size, k)), np.ones((n, size))
    live = mask[..., None]
    for t in range(size):
        a = here[:, 0] if t == 0 else (forward[:, t - 1] @ step) * here[:, t]
        scale[:, t] = np.where(mask[:, t], a.sum(1), 1)
        forward[:, t] = np.where(live[:, t], a / scale[:, t, None], forward[:, t - 1] if t else a)
    for t in range(size - 2, -1, -1):
        b = (here[:, t + 1] * backward[:, t + 1] / scale[:, t + 1, None]) @ step.T
        backward[:, t] = np.where(live[:, t + 1], b, 1)
    one = np.eye(k)[gold] * live
    marginal = forward * backward * live
    ahead = (here * backward / scale[..., None] * live)[:, 1:]
    both = step * (forward[:, :-1].reshape(-1, k).T @ ahead.reshape(-1, k))
    two = one[:, :-1].reshape(-1, k).T @ one[:, 1:].reshape(-1, k)
    log_z = (np.log(scale) + top[..., 0] * mask).sum()
    value = (scores * one).sum() + (pairs * two).sum() - log_z
    return value, one - marginal, two - both


def train(table=TABLE, steps: int = STEPS, penalty: float = PENALTY) -> Model:
    """Fit by gradient ascent with per-weight steps; the same table gives the same model."""
    rows = [(w, y) for w, y in map(parse, table) if w]
    near = set()
    for words, labels in rows:
        for i, w in enumerate(words):
            if any(labels[max(0, i - 2) : i + 3]):
                near |= {core(w), w.lower()}
    lexicon = frozenset(w for w in near if w and not _DIGIT.search(w))
    lists = [[features(w, lexicon) for w in words] for words, _ in rows]
    index: dict[str, int] = {"edge": 0}
    for row in lists:
        for found in row:
            for f in found:
                index.setdefault(f, len(index))
    size, k = max(len(w) for w, _ in rows), len(LABELS)
    mask = np.zeros((len(rows), size), bool)
    gold = np.zeros((len(rows), size), np.int64)
    has = np.zeros((len(rows) * size, 3, len(index)))  # features of each place's three words
    for r, (words, labels) in enumerate(rows):
        mask[r, : len(words)] = True
        gold[r, : len(words)] = labels
        around = [("edge",), *lists[r], ("edge",)]
        for t in range(len(words)):
            for p in range(3):
                has[r * size + t, p, [index[f] for f in around[t + p]]] = 1
    used = np.flatnonzero(mask.ravel())
    has = has.reshape(len(rows) * size, -1)[used]
    weights, pairs = np.zeros((3, len(index), k)), np.zeros((k, k))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(pairs), np.zeros_like(pairs)]
    for step in range(1, steps + 1):
        scores = np.zeros((len(rows) * size, k))
        scores[used] = has @ weights.reshape(-1, k)
        _, by_score, by_pair = likelihood(scores.reshape(len(rows), size, k), pairs, mask, gold)
        by_weight = (has.T @ by_score.reshape(-1, k)[used]).reshape(weights.shape)
        for x, g, m, v in (
            (weights, by_weight - penalty * weights, *state[:2]),
            (pairs, by_pair - penalty * pairs, *state[2:]),
        ):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        np.clip(pairs, -PAIR_LIMIT, PAIR_LIMIT, out=pairs)
    return Model(lexicon, index, weights, pairs)


def viterbi(scores: np.ndarray, pairs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best labels of padded sequences [sequences, places, labels], longest first; ties
    go to the smaller label."""
    n, size, k = scores.shape
    back = np.zeros((n, size, k), np.int8)
    best = scores[:, 0].copy()
    live = np.searchsorted(-lengths, -np.arange(size), side="left")  # sequences longer than t
    for t in range(1, size):
        a = live[t]
        step = best[:a, :, None] + pairs
        back[:a, t] = step.argmax(1)
        best[:a] = step.max(1) + scores[:a, t]
    out = np.zeros((n, size), np.int8)
    at = best.argmax(1)
    for t in range(size - 1, -1, -1):
        a = live[t]
        out[:a, t] = at[:a]
        at[:a] = back[np.arange(a), t, at[:a]]
    return out


def decode(model: Model, row: np.ndarray, tables: np.ndarray, gap: np.ndarray, area: int = 1 << 18) -> np.ndarray:
    """Labels of texts laid end to end: ``row`` holds the classes of their words, an edge
    (the last class) at both ends and between texts; ``tables`` is [classes, 3, labels],
    ``gap`` [classes, 3]."""
    edge = len(tables) - 1
    labels = np.zeros(len(row), np.int8)
    lead = gap[row[:-2], 0] + gap[row[1:-1], 1] + gap[row[2:], 2]
    open_ = np.flatnonzero((lead <= 1e-6) & (row[1:-1] != edge)) + 1
    if not len(open_):
        return labels
    cut = np.flatnonzero(np.diff(open_) > 1) + 1
    starts, ends = open_[np.r_[0, cut]], open_[np.r_[cut - 1, len(open_) - 1]] + 1
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    at = 0
    while at < len(order):
        width = int(sizes[order[at]])
        some = order[at : at + max(1, area // width)]
        at += len(some)
        inside = np.arange(width) < sizes[some, None]
        spot = np.where(inside, starts[some, None] + np.arange(width), 1)
        scores = tables[row[spot - 1], 0] + tables[row[spot], 1] + tables[row[spot + 1], 2]
        # the neighbours of a segment are O, unless a text ends there
        before, after = row[starts[some] - 1] != edge, row[ends[some]] != edge
        scores[:, 0] += np.where(before[:, None], model.pairs[0], 0)
        scores[np.arange(len(some)), sizes[some] - 1] += np.where(after[:, None], model.pairs[:, 0], 0)
        found = viterbi(scores, model.pairs, sizes[some])
        labels[spot[inside]] = found[inside]
    return labels


# ------------------------------------------------------------------ texts

_AT = re.compile(r"\s*(?:[(\[{]\s*(?:at|arroba|@)\s*[)\]}]|(?<=\s)(?:at|arroba)(?=\s)|@)\s*", re.IGNORECASE)
_DOT = re.compile(r"\s*(?:[(\[{]\s*(?:dot|\.)\s*[)\]}]|(?<=\s)dot(?=\s))\s*", re.IGNORECASE)
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_HEAD, _TAIL = ".,;:!?\"'<>{}*#$%&|)]_=", ".,;:!?\"'<>{}*#$%&|([_="


def proper(kind: str, text: str) -> bool:
    """Whether a proposed span is of its kind, after normalisation."""
    if len(text) > 200:
        return False
    if kind == "email":
        return bool(_ADDRESS.fullmatch(_AT.sub("@", _DOT.sub(".", text))))
    digits = _OTHER.sub("", text)
    if kind == "ip":
        parts = re.sub(r"[\s()\[\]]", "", text).split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and _octet(p) for p in parts)
    if _LETTERS.search(text):
        return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def _runs(labels: np.ndarray) -> list[tuple[str, int, int]]:
    """(kind, first word, end) of each labelled run."""
    out: list[tuple[str, int, int]] = []
    for t in np.flatnonzero(labels):
        kind, begins = KINDS[(labels[t] - 1) // 2], labels[t] % 2 == 1
        if out and not begins and out[-1][2] == t and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], int(t) + 1)
        else:
            out.append((kind, int(t), int(t) + 1))
    return out


def _trim(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in _HEAD:
        start += 1
    while end > start and text[end - 1] in _TAIL:
        end -= 1
    if text.count("(", start, end) > text.count(")", start, end) and text[start] == "(":
        start += 1
    elif text.count(")", start, end) > text.count("(", start, end) and text[end - 1] == ")":
        end -= 1
    return start, end


class _Classes(dict):
    """``classes[word]``: a number for each distinct list of features."""

    def __init__(self, lexicon: frozenset[str]):
        super().__init__()
        self.lexicon = lexicon
        self.lists: dict[tuple[str, ...], int] = {}

    def __missing__(self, word: str) -> int:
        found = features(word, self.lexicon)
        number = self[word] = self.lists.setdefault(found, len(self.lists))
        return number


class Tagger:
    """A trained model with what a worker keeps between slices."""

    def __init__(self, model: Model):
        self.model = model
        self.known = BoundedCache(model.scores, 50_000)
        self.gain = model.gains()

    def tables(self, lists) -> tuple[np.ndarray, np.ndarray]:
        """What :func:`decode` takes, for lists of features; the edge comes last."""
        tables = np.array([*map(self.known.__getitem__, lists), self.known[("edge",)]])
        lead = tables[:, :, :1] - tables[:, :, 1:]
        lead[:, 1] -= self.gain[1:]
        return tables, lead.min(2)

    def spans(self, batch: list[str]) -> list[list[tuple[str, int, int]]]:
        """The spans that the model adds to each text, in order."""
        classes = _Classes(self.model.lexicon)
        coded = [_coded(t, classes) for t in batch]
        tables, gap = self.tables(classes.lists)
        edge = np.array([len(tables) - 1], np.int32)
        row = np.concatenate([edge, *(x for c in coded for x in (c, edge))])
        labels = decode(self.model, row, tables, gap)
        out, at = [], 1
        for text, c in zip(batch, coded, strict=True):
            mine = labels[at : at + len(c)]
            at += len(c) + 1
            out.append(_proposed(text, _runs(mine)) if mine.any() else [])
        return out


def _coded(text: str, classes: _Classes) -> np.ndarray:
    """The class of each word; the words of a long text are held in pieces."""
    parts, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if len(text) - at > PIECE else None
        to = gap.start() if gap else len(text)
        words = WORD.findall(text, at, to)
        parts.append(np.fromiter(map(classes.__getitem__, words), np.int32, len(words)))
        at = to
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def _proposed(text: str, runs: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The labelled runs of words that are of their kind, as character spans."""
    places, out, at = WORD.finditer(text), [], -1
    for kind, first, end in runs:  # in order
        while at < first:
            m, at = next(places), at + 1
        start = m.start()
        while at < end - 1:
            m, at = next(places), at + 1
        s, e = _trim(text, start, m.end())
        if s < e and proper(kind, text[s:e]):
            out.append((kind, s, e))
    return out


def merged(base: list[tuple[str, int, int]], added: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Base spans and the added ones that meet none of them, by kind, then start."""
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in taken], np.int64)) if taken else starts
    free = []
    for kind, s, e in added:
        before = int(np.searchsorted(starts, e))  # base spans that begin before the end
        if before == 0 or ends[before - 1] <= s:
            free.append((kind, s, e))
    return sorted(base + free, key=lambda x: (KINDS.index(x[0]), x[1])) if free else base


@cache
def default_model() -> Model:
    return train()


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, base and added spans as text, counts and digest of the base spans."""
    model = model or default_model()

    def run(batches):
        tagger = Tagger(model)
        for batch in batches:
            for b in slices(batch, "text"):
                held = texts(b.column("text"))
                base = [base_spans(t) for t in held]
                more = tagger.spans(held)
                whole = [joined(merged(x, y)) for x, y in zip(base, more, strict=True)]
                counts = [[sum(k == kind for k, _, _ in x) for x in base] for kind in KINDS]
                digest = [hashlib.sha256(joined(x).encode()).hexdigest() for x in base]
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column("doc_id"),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(digest, pa.string()),
                        pa.array(whole, pa.string()),
                    ],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def personal_data(docs: DataFrame) -> DataFrame:
    """The contract's columns for every document."""
    return find_personal_data(docs)
