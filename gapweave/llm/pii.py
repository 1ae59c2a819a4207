"""Personal data: base patterns, and a semi-Markov conditional random field over whole spans.

The base finds emails, IP addresses, card and phone numbers by linear scans that give what
the leftmost non-overlapping matches of their patterns would. The field adds spans that the
base misses: near each digit, at sign or masked at sign, candidate segments of bounded length
are proposed by loose shapes, each segment is scored as a whole (checks, counts, what
stands beside it, cue words before it), and dynamic programming over the lattice of segments
chooses boundaries and kinds together. Its weights are fitted here, by the gradient of the
likelihood, on examples that a seeded generator writes.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.kernels import trimmed

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn", "iban")
#: Longest segment in characters, and characters of context around a trigger.
MAX_SEGMENT = 120
CONTEXT = 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|\[at\]|\(at\)", re.ASCII)
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns, sorted; each linear in the text."""
    out = []
    if "@" in text:
        floor = 0
        for m in _DOMAIN.finditer(text):
            a = m.start()
            while a > floor and text[a - 1] in _LOCAL:
                a -= 1
            if a < m.start():
                out.append((a, 0, m.end()))
                floor = m.end()
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            own = parts[i : i + 4]
            size = sum(map(len, own)) + 3
            if all(map(_small, own)):
                out.append((at, 1, at + size))
            at += size + 1
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


#: Loose shapes that propose segments from a start; a kind is not tied to its shape, the field decides.
_SHAPES = {
    "mail": re.compile(r"[\w.%+-]{1,40} ?(?:@|\[at\]|\(at\)) ?[\w-]{1,40}(?:\.[A-Za-z0-9-]{1,20}| ?(?:\[dot\]|\(dot\)) ?[A-Za-z0-9-]{1,20}){1,4}"),
    "quad": re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"),
    "long": re.compile(r"[0-9](?:[ -]?[0-9]){11,18}"),
    "call": re.compile(r"(?:\+|00)?[0-9]{0,3}[ .-]?\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4})?"),
    "trio": re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "land": re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?"),
    "hexa": re.compile(r"(?:[0-9a-f]{20,64}|[0-9A-F]{20,64})(?![0-9A-Za-z])"),
    "code": re.compile(r"[A-Za-z0-9_+/-]{16,100}={0,2}"),
}
#: Words that announce a kind, by class; fixed values.
_CUES = {
    "mail": {"mail", "email", "contact", "write"},
    "ip": {"ip", "host", "address", "server"},
    "card": {"card", "visa", "credit", "payment"},
    "phone": {"phone", "tel", "call", "fax", "mobile", "dial"},
    "secret": {"token", "key", "secret", "password", "passwd", "apikey", "auth", "bearer"},
    "ssn": {"ssn", "social", "security"},
    "iban": {"iban", "account", "bank"},
    "hash": {"commit", "sha", "md", "checksum", "digest", "hash", "uuid", "guid", "revision", "rev", "blob", "tree", "parent", "merge", "isbn", "doi", "etag", "file", "integrity"},
}
#: How keys of well-known services begin; fixed values.
_MARKED = re.compile(r"(?:AKIA|ASIA|gh[opsu]_|github_pat_|xox[abprs]-|sk[-_]|AIza|glpat-)")
_ASSIGNED = re.compile(r"(?:[=:]|=>)[ \"'`]*$")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_WORD = re.compile(r"[^\W\d_]+")
_FEATURES = (
    [f"shape_{s}" for s in _SHAPES]
    + [f"cue_{c}" for c in _CUES]
    + ["bias", "luhn", "quad_valid", "mod97", "hex_mixed", "code_mixed", "code_plain", "joined_left", "joined_right", "dot_left", "dot_right", "digits_lt_9", "digits_9_12", "digits_gt_12", "plus", "paren", "three_groups", "ssn_range", "assigned", "marked", "in_path", "uuid", "words"]
)
_AT = {f: i for i, f in enumerate(_FEATURES)}


def _features(text: str, a: int, b: int, shapes: frozenset[str]) -> list[int]:
    """Indices of the binary features of the whole span [a, b)."""
    span = text[a:b]
    digits = _NOT_DIGIT.sub("", span)
    letters = sum(c.isalpha() for c in span)
    on = ["bias", *(f"shape_{s}" for s in shapes)]
    left = text[max(0, a - 24) : a]
    before = {w.lower() for w in _WORD.findall(left)}
    on += [f"cue_{c}" for c, words in _CUES.items() if before & words]
    if len(digits) > 11 and not letters and luhn(digits):
        on.append("luhn")
    if "quad" in shapes and all(map(_small, span.split("."))):
        on.append("quad_valid")
    if "land" in shapes:
        packed = span.replace(" ", "")
        if len(packed) >= 15 and int("".join(str(int(c, 36)) for c in packed[4:] + packed[:4])) % 97 == 1:
            on.append("mod97")
    if "hexa" in shapes and digits and letters:
        on.append("hex_mixed")
    if "code" in shapes:
        on.append("code_mixed" if len(digits) >= 3 and letters >= 3 and len(set(span)) >= 9 else "code_plain")
        if _MARKED.match(span):
            on.append("marked")
        if _UUID.fullmatch(span):
            on.append("uuid")
        if len(re.findall(r"[-_/](?=[A-Za-z]{2})|(?<=[a-z])(?=[A-Z][a-z])", span)) >= 2:
            on.append("words")  # a name put together from words
    if _ASSIGNED.search(left):
        on.append("assigned")
    low = max(0, a - MAX_SEGMENT)
    if "/" in text[max(text.rfind(" ", low, a), text.rfind("\n", low, a), low - 1) + 1 : a]:
        on.append("in_path")
    for side, at, c in (("left", a - 1, text[a - 1 : a]), ("right", b, text[b : b + 1])):
        if c.isalnum() or c == "_":
            on.append(f"joined_{side}")
        elif c in ".-" and c and text[at - 1 if side == "left" else at + 1 : at if side == "left" else at + 2].isdigit():
            on.append(f"dot_{side}")
    on.append("digits_lt_9" if len(digits) < 9 else "digits_9_12" if len(digits) < 13 else "digits_gt_12")
    if span[0] == "+":
        on.append("plus")
    if "(" in span:
        on.append("paren")
    if "call" in shapes and len([g for g in re.split(r"[^0-9]+", span) if g]) >= 3:
        on.append("three_groups")
    if "trio" in shapes and span[:3] not in ("000", "666") and span[0] != "9":
        on.append("ssn_range")
    return [_AT[f] for f in on]


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches around triggers, cut at line ends; candidates lie in these."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        if out and m.start() < out[-1][2]:
            continue
        a = text.rfind("\n", max(0, m.start() - CONTEXT), m.start()) + 1 or max(0, m.start() - CONTEXT)
        b = text.find("\n", m.end(), m.end() + MAX_SEGMENT)
        b = min(len(text), m.end() + MAX_SEGMENT) if b < 0 else b
        if out and a <= out[-1][1]:
            out[-1][1:] = [b, min(b, m.end() + CONTEXT)]
        else:
            out.append([a, b, min(b, m.end() + CONTEXT)])
    return [(a, b) for a, b, _ in out]


_STARTS = re.compile(r"(?<![\w.%+-])[\w+(]|(?<=[^\W\d_])(?=[0-9])[0-9]|\+")


def segments(text: str, a: int, b: int) -> list[tuple[int, int, list[int]]]:
    """Candidate segments (start, end, features) of a zone, by start and end."""
    found: dict[tuple[int, int], set[str]] = {}
    for s in _STARTS.finditer(text, a, b):
        at = s.start()
        for name, shape in _SHAPES.items():
            m = shape.match(text, at, min(b, at + MAX_SEGMENT))
            if m and m.end() > at:
                found.setdefault((at, m.end()), set()).add(name)
    return [(x, y, _features(text, x, y, frozenset(s))) for (x, y), s in sorted(found.items())]


class SemiMarkov:
    """weights (feature, kind), transitions (label, label); label 0 is 'outside', label k+1 is kind k."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def _edges(self, found, a, b):
        """Nodes, and for each node the segments that end there."""
        nodes = sorted({a, b, *(x for x, _, _ in found), *(y for _, y, _ in found)})
        index = {n: i for i, n in enumerate(nodes)}
        into: list[list[tuple[int, int]]] = [[] for _ in nodes]
        for e, (x, y, _) in enumerate(found):
            into[index[y]].append((index[x], e))
        return nodes, into

    def scores(self, found) -> np.ndarray:
        return np.array([self.weights[f].sum(0) for _, _, f in found]).reshape(len(found), -1)

    def decode(self, found, a: int, b: int) -> list[tuple[int, int, int]]:
        """The best segmentation's spans (start, kind, end)."""
        nodes, into = self._edges(found, a, b)
        scores, n = self.scores(found), self.moves.shape[0]
        best = np.full((len(nodes), n), -np.inf)
        back: list[list] = [[None] * n for _ in nodes]
        best[0, 0] = 0
        for j in range(1, len(nodes)):
            step = best[j - 1] + self.moves[:, 0]
            label = int(step.argmax())
            best[j, 0], back[j][0] = step[label], (j - 1, label, None)
            for i, e in into[j]:
                reach = best[i][:, None] + self.moves[:, 1:]
                label_of = reach.argmax(0)
                total = reach.max(0) + scores[e]
                for k in np.flatnonzero(total > best[j, 1:]):
                    best[j, k + 1], back[j][k + 1] = total[k], (i, int(label_of[k]), e)
        out, j, label = [], len(nodes) - 1, int(best[-1].argmax())
        while j:
            i, before, e = back[j][label]
            if e is not None:
                out.append((found[e][0], label - 1, found[e][1]))
            j, label = i, before
        return out[::-1]

    def gradient(self, found, a, b, gold: dict[tuple[int, int], int]):
        """Gradient of the log-likelihood of the gold spans, by forward and backward sums over the lattice."""
        nodes, into = self._edges(found, a, b)
        scores, n, size = self.scores(found), self.moves.shape[0], len(nodes)
        forward, backward = np.full((size, n), -np.inf), np.full((size, n), -np.inf)
        forward[0, 0] = 0
        for j in range(1, size):
            forward[j, 0] = np.logaddexp.reduce(forward[j - 1] + self.moves[:, 0])
            for i, e in into[j]:
                forward[j, 1:] = np.logaddexp(forward[j, 1:], np.logaddexp.reduce(forward[i][:, None] + self.moves[:, 1:], axis=0) + scores[e])
        total = np.logaddexp.reduce(forward[-1])
        backward[-1] = 0
        d_weights, d_moves = np.zeros_like(self.weights), np.zeros_like(self.moves)
        for j in range(size - 1, 0, -1):
            out = self.moves[:, 0] + backward[j, 0]
            d_moves[:, 0] -= np.exp(forward[j - 1] + out - total)
            backward[j - 1] = np.logaddexp(backward[j - 1], out)
            for i, e in into[j]:
                out = self.moves[:, 1:] + scores[e] + backward[j, 1:]
                share = np.exp(forward[i][:, None] + out - total)
                d_moves[:, 1:] -= share
                d_weights[found[e][2]] -= share.sum(0)
                backward[i] = np.logaddexp(backward[i], np.logaddexp.reduce(out, axis=1))
        ends, label = {x: (y, k) for (x, y), k in gold.items()}, 0
        j, index = 0, {x: i for i, x in enumerate(nodes)}
        of = {(x, y): f for x, y, f in found}
        while j < size - 1:
            if nodes[j] in ends:
                y, k = ends[nodes[j]]
                d_weights[of[nodes[j], y], k] += 1
                d_moves[label, k + 1] += 1
                j, label = index[y], k + 1
            else:
                d_moves[label, 0] += 1
                j, label = j + 1, 0
        return d_weights, d_moves


def examples(n: int, seed: int) -> Iterator[tuple[str, list[tuple[int, int, int]]]]:
    """Generated lines with their gold spans (start, kind, end): each kind in several forms, and look-alikes without one."""
    rng = random.Random(seed)
    digits = lambda k: "".join(rng.choices("0123456789", k=k))
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstuvwéü", k=rng.randint(2, 9)))

    some = lambda of, k: "".join(rng.choices(of, k=k))
    every = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_"
    plainword = lambda: some("abcdefghijklmnoprstuvw", rng.randint(3, 8))
    name = lambda: rng.choice("-_").join(plainword() for _ in range(rng.randint(3, 6))) + rng.choice(["", f"-{digits(2)}", f"_{digits(4)}"])

    def card(ok=True):
        body = digits(15)
        last = next(str(d) for d in range(10) if luhn(body + str(d)))
        if not ok:
            last = str((int(last) + 1 + rng.randint(0, 8)) % 10)
        whole = body + last
        return whole if rng.random() < 0.6 else rng.choice(" -").join(whole[i : i + 4] for i in range(0, 16, 4))

    def iban(ok=True):
        body, land = digits(rng.choice([12, 14, 18])), rng.choice(["DE", "FR", "ES", "GB", "NL"])
        check = 98 - int(body + "".join(str(int(c, 36)) for c in land) + "00") % 97
        check = check if ok else (check + rng.randint(1, 90)) % 97
        whole = f"{land}{check:02d}{body}"
        return whole if rng.random() < 0.5 else " ".join(whole[i : i + 4] for i in range(0, len(whole), 4))

    def mail():
        name, host = word() + rng.choice(["", ".", "_"]) + word() + digits(rng.randint(0, 2)), f"{word()}{rng.choice(['', digits(1)])}"
        at, dot = rng.choice([("@", "."), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("@", "."), (" (at) ", ".")])
        return f"{name}{at}{host}{dot}{rng.choice(['com', 'org', 'net', 'example' + dot + 'com'])}"

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice([f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{rng.randint(20, 99)} {a} {b} {c}", f"00{rng.randint(20, 99)} {a} {b} {c}"])

    makes = {
        0: mail,
        1: lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        2: card,
        3: phone,
        4: lambda: rng.choice([some("0123456789abcdef", rng.choice([24, 32, 40, 48, 64])), some("0123456789ABCDEF", rng.choice([24, 32, 40])), some(every, rng.choice([20, 24, 32, 40])), some(every, 32), f"ghp_{some(every, 36)}", f"AKIA{some('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 16)}", f"sk-{some(every, 40)}"]),
        5: lambda: f"{rng.randint(1, 665):03d}-{rng.randint(10, 99)}-{digits(4)}",
        6: iban,
    }
    cues = {0: ["mail", "contact", ""], 1: ["host", "server", ""], 2: ["card", "visa", ""], 3: ["phone", "call", "tel", ""], 4: ["token =", "key:", "secret =", "password:", "api key =", "auth token", "bearer", "TOKEN ="], 5: ["ssn", "social security", "SSN:"], 6: ["iban", "account", "IBAN:", ""]}
    plain = [
        lambda: card(False), lambda: digits(rng.randint(1, 11)), lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 9)}", lambda: f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}",
        lambda: ".".join(str(rng.randint(256, 999)) for _ in range(4)), lambda: ".".join(str(rng.randint(0, 255)) for _ in range(rng.choice([3, 5, 6]))), lambda: f"{digits(2)}:{digits(2)}:{digits(2)}",
        lambda: f"version {rng.randint(1, 9)}", lambda: f"${digits(3)}.{digits(2)}", lambda: "-".join([word(), word(), digits(1), word()]), lambda: f"@{word()}", lambda: f"{word()}{digits(1)}/{word()}/{word()}", lambda: digits(rng.randint(20, 30)), lambda: iban(False),
        lambda: f"{rng.randint(1, 99)} {digits(3)} {digits(3)}", lambda: f"{digits(3)}-{digits(2)}-{digits(4)}-{digits(2)}",
        lambda: f"{rng.choice(['commit ', 'sha256:', 'sha256 ', 'md5 ', 'tree ', 'parent ', 'rev ', 'checksum: ', 'digest ', '', '', ''])}{some('0123456789abcdef', rng.choice([32, 40, 40, 64]))}",
        lambda: f"{rng.choice(['uuid ', 'id ', ''])}{'-'.join(some('0123456789abcdef', k) for k in (8, 4, 4, 4, 12))}",
        lambda: f"https://{word()}.{rng.choice(['com', 'org'])}/{word()}/{rng.choice([name(), some(every, 24), some('0123456789abcdef', 40)])}{rng.choice(['', '.html', '.png', '/'])}",
        lambda: f"{rng.choice(['/usr/', 'src/', './'])}{word()}/{name()}.{rng.choice(['py', 'txt', 'jar'])}", lambda: name(), lambda: f"{rng.choice(['key', 'token', 'password'])} {word()}", lambda: f"{rng.choice(['key', 'token'])} = {word()}_{word()}_{word()}_{word()}",
    ]
    for _ in range(n):
        text, gold = " ".join(word() for _ in range(rng.randint(0, 4))), []
        for _ in range(rng.randint(1, 3)):
            text += rng.choice([" ", ", ", ". "]) if text else ""
            if rng.random() < 0.55:
                kind = rng.randrange(len(KINDS))
                text += rng.choice(cues[kind])
                text += rng.choice([" ", ' "']) if text and text[-1] not in " " else ""
                span = makes[kind]()
                gold.append((len(text), kind, len(text) + len(span)))
                text += span + rng.choice(["", "", '"', ".", ",", "!!"])
            else:
                text += rng.choice(plain)()
            text += " " + " ".join(word() for _ in range(rng.randint(1, 3)))
        yield text, gold


@functools.lru_cache
def trained(n: int = 1500, rounds: int = 6, seed: int = 11, decay: float = 1e-4) -> SemiMarkov:
    """Fit on n generated lines by stochastic gradient steps scaled for each weight; the same on every call."""
    model = SemiMarkov(np.zeros((len(_FEATURES), len(KINDS))), np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    model.weights[_AT["bias"]] = -1.0
    cases = []
    for text, gold in examples(n, seed):
        found = segments(text, 0, len(text))
        there = {(x, y) for x, y, _ in found}
        gold = {(x, y): k for x, k, y in gold}
        if found and set(gold) <= there:
            cases.append((found, len(text), gold))
    squares = [np.full_like(model.weights, 1e-2), np.full_like(model.moves, 1e-2)]
    rng = random.Random(seed)
    for _ in range(rounds):
        rng.shuffle(cases)
        for found, size, gold in cases:
            steps = model.gradient(found, 0, size, gold)
            for value, step, square in zip((model.weights, model.moves), steps, squares):
                step = step - decay * value
                square += step * step
                value += 0.3 * step / np.sqrt(square)
    return model


def find(text: str, model: SemiMarkov) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of a text, both as (start, kind index, end), sorted."""
    if not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    every = list(base)
    for a, b in zones(text):
        found = segments(text, a, b)
        if found:
            # a span that the base has, or touches, is not the field's to add
            every += [s for s in model.decode(found, a, b) if all(s[2] <= x or s[0] >= y for x, _, y in base)]
    return base, sorted(set(every))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap, what they cover together goes under the first's kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, model: SemiMarkov | None = None, with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, counts of base spans, the base digest, all spans, the redacted text
    (null unless with_text).

    Columns read: doc_id, text; others are ignored. A null or empty text has no spans and redacts
    to itself. Rows are independent, so ties, repeats and null doc_ids pass through. An empty table
    gives an empty table.
    """
    model = model or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, every = find(text or "", model)
                count = [0] * len(BASE_KINDS)
                for _, k, _ in base:
                    count[k] += 1
                rows.append((*count, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), (redact(text, every) if every else text) if with_text else None))
            if rows:
                *counts, digest, spans, texts = zip(*rows)
                arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digest), pa.array(spans), pa.array(texts, pa.string())]
                yield pa.record_batch(arrays, ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "redacted"])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), schema)


def redact_documents(docs: DataFrame, model: SemiMarkov | None = None) -> DataFrame:
    """docs with every span in text replaced by its kind in brackets; n_chars, if there is one, follows a changed
    text. All columns stay; nulls and empty texts too."""
    model = model or trained()
    names = docs.columns
    at, size = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, texts = list(batch.columns), batch.column(at).to_pylist()
            spans = [find(t, model)[1] if t else [] for t in texts]
            if any(spans):
                clean = [redact(t, s) if s else t for t, s in zip(texts, spans)]
                columns[at] = pa.array(clean, columns[at].type)
                if size >= 0:
                    columns[size] = pa.array([len(c) if s else n for c, s, n in zip(clean, spans, columns[size].to_pylist())], columns[size].type)
            yield pa.record_batch(columns, names)

    return docs.mapInArrow(trimmed(run), docs.schema)
