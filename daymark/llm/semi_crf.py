"""Personal data in text: base patterns, and a semi-Markov conditional random field.

The base patterns find emails, IPv4 addresses, card numbers and phone numbers; their spans
always stay. The field adds spans that the patterns miss: two card numbers that stand next
to each other, addresses with spelled-out signs, phone numbers without a plus sign.

Candidate segments of bounded length are proposed generously and may overlap: for cards and
phones all segments of whole neighbouring digit groups with a right number of digits (phones
also with a plus, a double zero or a usual shape), emails with each number of domain parts,
and what the base patterns find. A segment's score is a weighted sum of features of the whole span and its
neighbourhood. Semi-Markov dynamic programming over the candidates, with a transition
weight between the types of neighbouring segments, chooses borders and types together, but
never what contradicts a base span.
Text without a candidate takes no part in the sum, so the work follows the candidates; a
text without a digit, an at sign, '(at)' or '[at]' can have none and is not searched.

Weights are learned by gradient steps on the conditional likelihood, on a bounded sample of
groups of candidates: at most 20 of each of at most 2000 distinct texts, at most 2000 distinct ones of
all, both picked by a hash of the group's own surroundings (``train`` has all bounds). Their segmentation is the base patterns' own; a candidate
that only the generous patterns know is unlabelled, so both its readings count. A Gaussian
prior around fixed starting weights keeps features that the sample does not show.

Rows: a null text counts as empty; an empty text has no spans. Equal texts give equal
spans, repeated rows one row each. Any text length is handled whole: all patterns are
linear, and segments are at most 80 characters. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.common import distinct_texts, picked_texts, with_computed

KINDS = ("email", "ip", "card", "phone")
#: Texts that the weights are learned on.
SAMPLE_ROWS = 2000
#: Groups of candidates that one text gives to learning, and candidates in a group and in all.
SAMPLE_GROUPS = 20
GROUP_CANDIDATES = 200
SAMPLE_CANDIDATES = 20_000
LONGEST = 80
STEPS = 150

#: Texts without any of these have no candidates; the same pattern is read by Java.
TRIGGER_PATTERN = r"[0-9@]|\(at\)|\[at\]"
TRIGGER = re.compile(TRIGGER_PATTERN)
AT_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match never begins inside a run of digits: one that did would begin at its start.
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Generous patterns; all quantifiers are bounded or possessive. Matches may overlap.
WIDE_EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])(?=([A-Za-z0-9._%+-]{1,40} ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,30}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,20}){1,3}))"
)
AT_SIGN = re.compile(r"@|\(at\)|\[at\]")
DOMAIN_PART = re.compile(r" ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,20}")
DOMAIN_GOES_ON = re.compile(r"\.[A-Za-z0-9-]| ?(?:\(dot\)|\[dot\])")
GROUP = re.compile(r"[0-9]++")
CARD_GAP = re.compile(r"[ .-]")
PHONE_GAP = re.compile(r"[ ().-]{1,3}")
CARD_DIGITS = range(13, 20)
PHONE_DIGITS = range(9, 16)
#: How the digits of cards are grouped, where they are not in one group.
CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 5), (4, 3, 3, 3), (6, 13)}
PHONE_SHAPE = re.compile(r"\([0-9]{2,4}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}")
DIGITS = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Segment:
    start: int
    end: int
    kind: str


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Segment]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and AT_LOCAL.match(text[start - 1]):
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield Segment(start, found.end(), "email")
            done = found.end()
        else:
            # Local parts hold no "@", so none reaches back over this one.
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Segment]:
    """Spans of the base patterns, by kind, then start."""
    out: list[Segment] = []
    if not TRIGGER.search(text):
        return out
    out += _emails(text)
    out += [Segment(*m.span(), "ip") for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.groups())]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(Segment(*m.span(), "card"))
    out += [Segment(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


def _number_segments(text: str) -> Iterator[Segment]:
    """Cards and phones: all segments of whole neighbouring groups of digits that have the
    right number of digits; phones also need a plus, a double zero, or a usual shape."""
    groups = [m.span() for m in GROUP.finditer(text)]
    for i, (a, _) in enumerate(groups):
        lead = text[a - 1] if a else " "
        bracket = lead == "("
        plus = lead == "+"
        start = a - 1 if bracket or plus else a
        shaped = PHONE_SHAPE.match(text, start)
        dialled = plus or text.startswith("00", a)
        digits, card, phone = 0, True, dialled or shaped is not None
        for k in range(i, len(groups)):
            if k > i:
                gap = groups[k - 1][1], groups[k][0]
                card = card and CARD_GAP.fullmatch(text, *gap) is not None
                phone = phone and PHONE_GAP.fullmatch(text, *gap) is not None
            b = groups[k][1]
            digits += b - groups[k][0]
            if not (card or phone) or digits > CARD_DIGITS[-1] or b - start > LONGEST:
                break
            if card and digits in CARD_DIGITS:
                yield Segment(a, b, "card")
            if phone and digits in PHONE_DIGITS and (dialled or b == shaped.end()):
                yield Segment(start, b, "phone")


def candidates(text: str, base: list[Segment]) -> list[Segment]:
    """Base spans and what the generous patterns propose, by end, then start."""
    found = set(base)
    if not TRIGGER.search(text):
        return []
    for m in WIDE_EMAIL.finditer(text):
        a, b = m.span(1)
        sign = AT_SIGN.search(text, a, b)
        ends = [part.end() for part in DOMAIN_PART.finditer(text, sign.end(), b)]
        found.update(Segment(a, end, "email") for end in ends if end - a <= LONGEST)
    found.update(_number_segments(text))
    for m in IP.finditer(text):
        if m.end() - m.start() <= LONGEST:
            found.add(Segment(*m.span(), "ip"))
    return sorted(found, key=lambda s: (s.end, s.start, s.kind))


#: Starting weights, the mean of the prior: fixed values.
PRIOR = {
    "bias": -2.0,
    "card:luhn": 4.0,
    "card:not luhn": -6.0,
    "card:13 to 19 digits": 1.0,
    "card:one digit only": -6.0,
    "card:word before": -3.0,
    "card:word after": -3.0,
    "card:decimal": -3.0,
    "card:usual groups": 0.5,
    "card:odd groups": -6.0,
    "card:no issuer": -1.0,
    "email:at sign": 2.0,
    "email:spelled sign": 2.5,
    "email:domain ends in letters": 2.0,
    "email:domain ends in digits": -3.0,
    "email:space inside": -2.0,
    "email:domain goes on": -1.0,
    "ip:parts fit": 4.0,
    "ip:part too large": -8.0,
    "ip:longer chain": -4.0,
    "phone:plus": 4.0,
    "phone:double zero": 1.0,
    "phone:brackets": 3.0,
    "phone:grouped": 2.5,
    "phone:digits fit": 1.0,
    "phone:digits do not fit": -6.0,
    "phone:word before": -3.0,
    "phone:word after": -3.0,
    "same kind again": 0.5,
    "other kind next": 0.0,
}
NAMES = list(PRIOR)
NUMBER = {n: i for i, n in enumerate(NAMES)}


def span_features(text: str, s: Segment) -> list[int]:
    """Features of a whole segment, as numbers of ``NAMES``."""
    span = text[s.start : s.end]
    before = text[s.start - 1] if s.start else " "
    after = text[s.end] if s.end < len(text) else " "
    digits = "".join(DIGITS.findall(span))
    names = ["bias"]
    if s.kind == "card":
        names.append("card:luhn" if luhn(digits) else "card:not luhn")
        if 13 <= len(digits) <= 19:
            names.append("card:13 to 19 digits")
        if len(set(digits)) == 1:
            names.append("card:one digit only")
        if "." in (before, after) and DIGITS.match(text[s.end + 1 : s.end + 2] or " "):
            names.append("card:decimal")
        sizes = tuple(map(len, GROUP.findall(span)))
        if len(sizes) > 1:
            names.append("card:usual groups" if sizes in CARD_GROUPS else "card:odd groups")
        if not ("3" <= digits[0] <= "6" or "2221" <= digits[:4] <= "2720"):
            names.append("card:no issuer")
    elif s.kind == "email":
        names.append("email:at sign" if "@" in span else "email:spelled sign")
        last = re.split(r"[.)\]]", span)[-1].strip()
        names.append("email:domain ends in letters" if last.isalpha() and len(last) > 1 else "email:domain ends in digits")
        if " " in span:
            names.append("email:space inside")
        if DOMAIN_GOES_ON.match(text, s.end):
            names.append("email:domain goes on")
    elif s.kind == "ip":
        parts = span.split(".")
        names.append("ip:parts fit" if all(len(p) <= 3 and int(p) <= 255 for p in parts) else "ip:part too large")
        if before == "." or (after == "." and DIGITS.match(text[s.end + 1 : s.end + 2] or " ")):
            names.append("ip:longer chain")
    else:
        if span[0] == "+":
            names.append("phone:plus")
        elif span.startswith("00"):
            names.append("phone:double zero")
        elif span[0] == "(":
            names.append("phone:brackets")
        else:
            names.append("phone:grouped")
        names.append("phone:digits fit" if 9 <= len(digits) <= 15 else "phone:digits do not fit")
    if s.kind in ("card", "phone"):
        if before.isalnum() or before in "-_":
            names.append(f"{s.kind}:word before")
        if after.isalnum() or after in "-_":
            names.append(f"{s.kind}:word after")
    return [NUMBER[n] for n in names]


def _islands(segments: list[Segment]) -> Iterator[list[Segment]]:
    """Candidates in groups; segments of one group are less than 40 characters apart."""
    group: list[Segment] = []
    reach = -1
    for s in sorted(segments, key=lambda s: (s.start, s.end, s.kind)):
        if group and s.start > reach + 40:
            yield sorted(group, key=lambda s: (s.end, s.start, s.kind))
            group = []
        group.append(s)
        reach = max(reach, s.end)
    if group:
        yield sorted(group, key=lambda s: (s.end, s.start, s.kind))


def _link(a: Segment, b: Segment) -> int:
    return NUMBER["same kind again" if a.kind == b.kind else "other kind next"]


def _previous(group: list[Segment]) -> list[range]:
    """For each segment the earlier ones that end before it starts; all are in front."""
    ends = [s.end for s in group]
    return [range(bisect_right(ends, s.start)) for s in group]


#: Numbers of the transition weights from a kind (row) to a kind (column).
LINKS = np.array([[_link(Segment(0, 0, a), Segment(0, 0, b)) for b in KINDS] for a in KINDS])


def best_path(group: list[Segment], scores: np.ndarray, weights: np.ndarray) -> list[Segment]:
    """The segmentation of the highest score; segments outside of it are plain text."""
    link = weights[LINKS].tolist()
    best: list[float] = []
    back: list[int] = []
    # For each kind: the best path that ends in it within the first i segments, and its last one.
    prefix: list[list[tuple[float, int]]] = [[(-np.inf, -1)] for _ in KINDS]
    for i, (s, earlier) in enumerate(zip(group, _previous(group), strict=True)):
        kind = KINDS.index(s.kind)
        top, arg = 0.0, -1
        for k, reached in enumerate(prefix):
            value, j = reached[len(earlier)]
            if value + link[k][kind] > top:
                top, arg = value + link[k][kind], j
        best.append(float(scores[i]) + top)
        back.append(arg)
        for k, reached in enumerate(prefix):
            reached.append((best[i], i) if k == kind and best[i] > reached[-1][0] else reached[-1])
    top, i = max((r[-1] for r in prefix), key=lambda r: r[0])
    i = i if top > 0 else -1
    path = []
    while i >= 0:
        path.append(group[i])
        i = back[i]
    return path[::-1]


def log_sum(group: list[Segment], scores: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log of the sum over all segmentations, the segments' probabilities, and how many links
    from a kind (row) to a kind (column) are expected."""
    n, link = len(group), weights[LINKS]
    kinds = [KINDS.index(s.kind) for s in group]
    earlier = [len(e) for e in _previous(group)]
    ahead = np.zeros(n)
    # Sums of all paths that end in a segment of each kind within the first i segments.
    total = np.full((n + 1, len(KINDS)), -np.inf)
    for i, kind in enumerate(kinds):
        ahead[i] = scores[i] + np.logaddexp.reduce(total[earlier[i]] + link[:, kind], initial=0.0)
        total[i + 1] = total[i]
        total[i + 1, kind] = np.logaddexp(total[i, kind], ahead[i])
    z = np.logaddexp.reduce(total[n], initial=0.0)
    # Backward: sums of all that may follow a segment, by the kind of what comes next.
    after, follow = np.zeros(n), np.full(len(KINDS), -np.inf)
    waiting: list[list[int]] = [[] for _ in range(n + 1)]
    for j, e in enumerate(earlier):
        waiting[e].append(j)
    for i in range(n - 1, -1, -1):
        for j in waiting[i + 1]:
            follow[kinds[j]] = np.logaddexp(follow[kinds[j]], scores[j] + after[j])
        after[i] = np.logaddexp.reduce(follow + link[kinds[i]], initial=0.0)
    links = np.zeros((len(KINDS), len(KINDS)))
    for i, kind in enumerate(kinds):
        links[:, kind] += np.exp(total[earlier[i]] + link[:, kind] + scores[i] + after[i] - z)
    return z, np.exp(ahead + after - z), links


def learn(texts: list[str], *, steps: int = STEPS, rate: float = 0.1, spread: float = 2.0) -> np.ndarray:
    """Weights that make the base patterns' spans likely, near the prior's mean."""
    start = np.array([PRIOR[n] for n in NAMES])
    # Groups that look alike to the model count together.
    cases: Counter = Counter()
    groups: dict = {}
    for text in texts:
        base = base_spans(text)
        for group in _islands(candidates(text, base)):
            known = set(base) & set(group)
            # Readings that contradict a base span are wrong; the others are unlabelled.
            push = [30.0 if s in known else -30.0 if any(s.start < k.end and k.start < s.end for k in known) else 0.0 for s in group]
            found = [span_features(text, s) for s in group]
            like = (tuple(map(tuple, found)), tuple(push), tuple(len(e) for e in _previous(group)), tuple(s.kind for s in group))
            cases[like] += 1
            groups.setdefault(like, (group, found, np.array(push)))
    if not cases:
        return start
    total = sum(cases.values())
    weights, speed = start.copy(), np.zeros(len(start))
    for _ in range(steps):
        gradient = (start - weights) / (spread**2 * total)
        for like, (group, found, push) in groups.items():
            scores = np.array([weights[f].sum() for f in found])
            for sign, given in ((cases[like], scores + push), (-cases[like], scores)):
                _, into, links = log_sum(group, given, weights)
                for f, p in zip(found, into, strict=True):
                    np.add.at(gradient, f, sign * p / total)
                np.add.at(gradient, LINKS, sign * links / total)
        speed = 0.9 * speed + rate * gradient
        weights = weights + speed
    return weights


def spans(text: str | None, weights: np.ndarray) -> tuple[list[Segment], list[Segment]]:
    """The base spans, and all spans: base ones and those that the field adds."""
    if not text or not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    taken = sorted((s.start, s.end) for s in base)
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else []

    def free(s: Segment) -> bool:
        i = bisect_left(taken, (s.end,))
        return i == 0 or reach[i - 1] <= s.start

    # What contradicts a base span takes no part, so it can't stand in the way of others.
    known, added = set(base), set()
    for group in _islands([s for s in candidates(text, base) if s in known or free(s)]):
        scores = np.array([weights[span_features(text, s)].sum() for s in group])
        added.update(best_path(group, scores, weights))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted({*base, *filter(free, added)}, key=lambda s: (order[s.kind], s.start, s.end))


def listed(segments: list[Segment]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in segments)


def by_hash(part: str) -> tuple[bytes, str]:
    return hashlib.blake2b(part.encode("utf-8", "surrogatepass"), digest_size=8).digest(), part


def chosen(parts: set[str], most: int) -> list[str]:
    """At most ``most`` parts in the order of their hash, and as many as the candidates allow."""
    out, room = [], SAMPLE_CANDIDATES
    for part in sorted(parts, key=by_hash)[:most]:
        room -= len(candidates(part, base_spans(part)))
        if room < 0:
            break
        out.append(part)
    return out


def train(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights from at most ``sample_rows`` distinct texts with a digit or an at sign, also a spelled-out one,
    picked by a hash.

    Of each text only the surroundings of its groups of candidates reach the driver: the
    ``SAMPLE_GROUPS`` of the smallest hash, wherever they stand, without groups of more than
    ``GROUP_CANDIDATES``. Of all distinct ones, the ``sample_rows`` of the smallest hash are
    learned from, or fewer where they hold more than ``SAMPLE_CANDIDATES`` candidates.
    """
    rows = docs.select("text").where(F.col("text").rlike(TRIGGER_PATTERN))
    texts = picked_texts(rows, distinct_texts(rows), sample_rows)

    def cut(texts: list[str | None]) -> list[list]:
        out = []
        for text in texts:
            groups = [g for g in _islands(candidates(text, base_spans(text))) if len(g) <= GROUP_CANDIDATES]
            parts = {text[max(0, min(s.start for s in g) - 45) : max(s.end for s in g) + 45] for g in groups}
            out.append(sorted(parts, key=by_hash)[:SAMPLE_GROUPS])
        return [out]

    sample = with_computed(texts, "text", "parts array<string>", cut).drop("text").dropDuplicates(["h"]).toPandas()
    return learn(chosen({p for parts in sample["parts"] for p in parts}, sample_rows))


def personal_data(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_added of each row.

    The counts and the digest are those of the base spans; ``spans`` lists all.
    """
    weights = train(docs, sample_rows=sample_rows)

    def compute(texts: list[str | None]) -> list[list]:
        columns: list[list] = [[] for _ in range(7)]
        for text in texts:
            base, all_spans = spans(text, weights)
            counts = [sum(s.kind == k for s in base) for k in KINDS]
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            for column, value in zip(columns, [*counts, digest, listed(all_spans), len(all_spans) - len(base)], strict=True):
                column.append(value)
        return columns

    ddl = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return with_computed(docs.select("doc_id", "text"), "text", ddl, compute).drop("text")
