"""Personal data as character spans: fixed patterns, and a semi-Markov conditional random field for other writings.

The patterns find e-mail addresses, IP addresses, card numbers and phone numbers as usually written. The field
finds the same four types written otherwise (``name [at] host dot com``, spaced or bracketed numbers): stretches of
tokens around digits and address signs outside the pattern spans are cut into segments by dynamic programming,
which chooses boundaries and types together. An entity has at most ``LONGEST`` tokens and is scored as a whole
(digit counts, groups, check digits, separators, what stands left and right); every other token is a segment of
its own with score 0.

Training takes a bounded sample: the windows of ``AROUND`` characters around digits and address signs in at most
``sample`` documents chosen by a hash of their text. Pattern spans are the labels, rewritten at random (seeded) in the
other ways; digits outside of them are counter-examples. Without any example nothing is added.

Null text counts as empty. Results depend on each text alone once the field is trained; repeated rows get equal
rows, an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import give_back, id_and_text, tidy

KINDS = ("email", "ip", "card", "phone")
# The patterns of the base spans.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

SAMPLE, AROUND, LONGEST, MARGIN = 400, 48, 24, 1.0
EPOCHS, RATE, DECAY, SEED = 8, 0.3, 1e-3, 7
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[\s\S]")
_SIGN = re.compile(r"[0-9]|@|\b[Dd][Oo][Tt]\b")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _ip_ok(parts) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` by kind and start."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            out.append(("email", start, found.end()))
            free = found.end()
        at = text.find("@", max(at + 1, free))
    if not _DIGITS.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _ip_ok(m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub("[^0-9]", "", m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# ---------------------------------------------------------------- segments and their features

_NUMERIC = frozenset("+().-[]")
_ADDRESS = frozenset("._%+-@[]()")


def merged(spans) -> list[tuple[int, int]]:
    """The places that spans cover, as intervals that do not overlap, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _overlaps(tokens, taken) -> list[bool]:
    """Which tokens overlap one of the ``merged`` intervals: one walk over both."""
    out, at = [], 0
    for s, e in tokens:
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        out.append(at < len(taken) and taken[at][0] < e)
    return out


class _Stretch:
    """Tokens of a piece of text, and the segments that may be entities: with their features, or given ``weights`` with their
    scores, of which only those above ``margin`` are held. ``taken`` are ``merged`` intervals no entity may touch."""

    def __init__(self, text: str, start: int, stop: int, taken=(), weights: dict | None = None, margin: float = 0.0):
        self.text, self.weights, self.margin = text, weights, margin
        self.tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, start, stop)]
        blocked = _overlaps(self.tokens, taken)
        words = [text[s:e] for s, e in self.tokens]
        self.segments: list[tuple] = []
        for i, word in enumerate(words):
            if blocked[i]:
                continue
            if word[0] in "0123456789" or word in "+(":
                self._numbers(words, blocked, i)
            if word.isalnum() and word.lower() not in ("at", "dot"):
                self._addresses(words, blocked, i)

    def _numbers(self, words, blocked, i):
        digits = 0
        for j in range(i, min(len(words), i + LONGEST)):
            word = words[j]
            if blocked[j] or not (word[0] in "0123456789" or word in _NUMERIC or (word == " " and words[j - 1] != " ")):
                return
            if word[0] in "0123456789":
                digits += len(word)
                if digits > 24:
                    return
                if digits >= 4:
                    for kind in ("ip", "card", "phone"):
                        self._add(words, i, j + 1, kind)

    def _addresses(self, words, blocked, i):
        signs = dots = 0
        for j in range(i, min(len(words), i + LONGEST)):
            word = words[j]
            spoken = word.lower() if word.isalpha() else ""
            if blocked[j] or not (word.isalnum() or word in _ADDRESS or word == " "):
                return
            if word == " " and not any(0 <= k < len(words) and (words[k].lower() in ("at", "dot") or words[k] in "@.[]()") for k in (j - 1, j + 1)):
                return
            signs += word == "@" or spoken == "at"
            dots += bool(signs) and (word == "." or spoken == "dot")
            if signs > 1:
                return
            if signs and dots and word.isalnum() and spoken not in ("at", "dot"):
                self._add(words, i, j + 1, "email")

    def _add(self, words, i: int, j: int, kind: str) -> None:
        held = self._features(kind, words, i, j)
        if self.weights is not None:
            held = _score(self.weights, held) - self.margin
            if held <= 0:
                return
        self.segments.append((i, j, kind, held))

    def _features(self, kind: str, words, i: int, j: int) -> tuple:
        span = "".join(words[i:j])
        left, right = (words[i - 1] if i else ""), (words[j] if j < len(words) else "")
        after = words[j + 1] if j + 1 < len(words) else ""
        out = ["bias", f"left={_shape(left)}", f"right={_shape(right)}{_shape(after) if right in ('.', '-', ',') else ''}"]
        if kind == "email":
            tail = words[j - 1]
            out += [f"sign={'@' if '@' in span else 'at'}", f"bracket={'[' in span or '(' in span}", f"tail={tail.isalpha() and 2 <= len(tail) <= 4}",
                    f"dots={min(4, span.count('.') + span.lower().count('dot'))}", f"space={span.count(' ') > 4}", f"first={words[i].isalpha()}"]
        else:
            groups = re.findall("[0-9]+", span)
            digits = "".join(groups)
            out += [f"digits={len(digits)}", f"groups={min(6, len(groups))}", f"plus={span[0] == '+'}", f"luhn={13 <= len(digits) <= 19 and _luhn(digits)}",
                    f"parts={len(groups) == 4 and _ip_ok(groups)}", f"dots={min(4, span.count('.'))}", f"marks={''.join(sorted(set(re.sub('[0-9]', '', span))))}",
                    f"lengths={'-'.join(str(min(9, len(g))) for g in groups[:5])}"]
        return tuple(f"{kind}:{f}" for f in out)


def _shape(word: str) -> str:
    if not word:
        return "none"
    if word.isspace():
        return "space"
    return "letter" if word.isalpha() else "digit" if word[0].isdigit() else word if word in ".,;:+-=@/\"'()" else "other"


def _score(weights: dict, features: tuple) -> float:
    return sum(map(weights.get, features, [0.0] * len(features)))


def best_segments(stretch: _Stretch, weights: dict | None = None, margin: float = 0.0) -> list[tuple[str, int, int]]:
    """The best cut into entities and single tokens; an entity has to beat its tokens by ``margin``, or by that of a scored stretch."""
    n = len(stretch.tokens)
    ending: dict[int, list] = {}
    for i, j, kind, held in stretch.segments:
        value = held if stretch.weights is not None else _score(weights or {}, held) - margin
        if value > 0:
            ending.setdefault(j, []).append((value, i, kind))
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for value, i, kind in ending.get(j, ()):
            if best[i] + value > best[j]:
                best[j], back[j] = best[i] + value, (i, kind)
    out, j = [], n
    while j:
        if back[j] is None:
            j -= 1
        else:
            i, kind = back[j]
            out.append((kind, stretch.tokens[i][0], stretch.tokens[j - 1][1]))
            j = i
    return out[::-1]


def _log_add(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high + math.log1p(math.exp(low - high))


def _gradient(stretch: _Stretch, gold: set, weights: dict) -> dict:
    """Observed minus expected features, by the forward and backward sums over all segmentations."""
    n, segments = len(stretch.tokens), stretch.segments
    values = [_score(weights, f) for *_, f in segments]
    ending: dict[int, list[int]] = {}
    starting: dict[int, list[int]] = {}
    for k, (i, j, *_) in enumerate(segments):
        ending.setdefault(j, []).append(k)
        starting.setdefault(i, []).append(k)
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        forward[j] = forward[j - 1]
        for k in ending.get(j, ()):
            forward[j] = _log_add(forward[j], forward[segments[k][0]] + values[k])
    for i in range(n - 1, -1, -1):
        backward[i] = backward[i + 1]
        for k in starting.get(i, ()):
            backward[i] = _log_add(backward[i], backward[segments[k][1]] + values[k])
    out: dict[str, float] = {}
    for k, (i, j, kind, features) in enumerate(segments):
        step = ((kind, stretch.tokens[i][0], stretch.tokens[j - 1][1]) in gold) - math.exp(forward[i] + values[k] + backward[j] - forward[n])
        if abs(step) > 1e-4:
            for f in features:
                out[f] = out.get(f, 0.0) + step
    return out


# ---------------------------------------------------------------- training

def _rewritten(kind: str, value: str, draw: random.Random) -> str:
    """The same datum written otherwise."""
    if kind == "email":
        local, domain = value.rsplit("@", 1)
        sign, dot = draw.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" @ ", "."), ("(at)", "."), (" [at] ", " [dot] ")])
        return local + sign + domain.replace(".", dot)
    digits = re.findall("[0-9]+", value)
    if kind == "ip":
        return draw.choice(["[.]", " . ", "(.)"]).join(digits)
    joined = "".join(digits)
    if kind == "card":
        return draw.choice([".", " - "]).join(joined[i:i + 4] for i in range(0, len(joined), 4))
    if len(joined) == 11:
        area, mid, end = joined[1:4], joined[4:7], joined[7:]
        return draw.choice([f"({area}) {mid}-{end}", f"{area}-{mid}-{end}", f"{area}.{mid}.{end}", f"+({joined[0]}) {area} {mid} {end}"])
    return " ".join(digits)


def examples(windows: list[str], seed: int = SEED) -> list[tuple[str, set]]:
    """Labelled texts: every window as it is, and with each pattern span rewritten."""
    draw, out = random.Random(seed), []
    for text in windows:
        spans = sorted(base_spans(text), key=lambda s: (s[1], -s[2]))
        kept, free = [], 0
        for span in spans:
            if span[1] >= free:
                kept.append(span)
                free = span[2]
        out.append((text, set(kept)))
        if kept:
            parts, gold, at, size = [], set(), 0, 0
            for kind, start, end in kept:
                new = _rewritten(kind, text[start:end], draw)
                parts += [text[at:start], new]
                size += start - at
                gold.add((kind, size, size + len(new)))
                size += len(new)
                at = end
            out.append(("".join(parts) + text[at:], gold))
    return out


def train(windows: list[str], epochs: int = EPOCHS) -> dict[str, float]:
    """Feature weights by stochastic gradient steps with decay, in a fixed order."""
    weights: dict[str, float] = {}
    sums: dict[str, float] = {}
    rows = [(_Stretch(text, 0, len(text)), gold) for text, gold in examples(sorted(set(windows)))]
    rows = [(s, g) for s, g in rows if s.segments]
    draw = random.Random(SEED)
    for _ in range(epochs):
        draw.shuffle(rows)
        for stretch, gold in rows:
            for f, g in _gradient(stretch, gold, weights).items():
                g -= DECAY * weights.get(f, 0.0)
                sums[f] = sums.get(f, 1e-2) + g * g
                weights[f] = weights.get(f, 0.0) + RATE * g / math.sqrt(sums[f])
    return weights


def training_windows(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` windows: one for each sampled text with a digit or an address sign.

    Texts are drawn by a hash below a bound that follows from their count, so few reach the driver.
    """
    texts = docs.filter(F.contains("text", F.lit("@")) | F.col("text").rlike("[0-9]")).select("text", F.pmod(F.xxhash64("text"), F.lit(1 << 20)).alias("draw"))
    count = texts.count()
    if not count:
        return []
    bound = min(1 << 20, (1 << 20) * 2 * sample // count + 1)
    place = F.regexp_instr("text", F.lit("[0-9@]"))
    rows = (texts.filter(F.col("draw") < bound).select("draw", F.substring("text", F.greatest(place - AROUND, F.lit(1)), F.lit(2 * AROUND)).alias("text"))
            .orderBy("draw", "text").limit(sample).collect())
    return [r["text"] for r in rows]


def added_spans(text: str, base: list[tuple[str, int, int]], weights: dict, margin: float = MARGIN) -> list[tuple[str, int, int]]:
    """Entities of the field outside the pattern spans."""
    if not weights:
        return []
    taken = merged((a, b) for _, a, b in base)
    ends = [b for _, b in taken]
    stretches: list[list[int]] = []
    at = 0
    for m in _SIGN.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at < len(taken) and taken[at][0] <= m.start():
            continue
        start, stop = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if stretches and start <= stretches[-1][1]:
            stretches[-1][1] = stop
        else:
            stretches.append([start, stop])
    out = []
    for start, stop in stretches:
        near = taken[bisect.bisect_right(ends, start):bisect.bisect_left(taken, (stop, 0))]
        out += best_segments(_Stretch(text, start, stop, near, weights, margin))
    return out


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def find(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for every row; one pass after training."""
    docs = id_and_text(docs)
    weights = train(training_windows(docs, sample))

    @tidy
    def run(batches):
        for batch in batches:
            counts, digests, all_spans = {k: [] for k in KINDS}, [], []
            for text in batch.column(1):
                text = text.as_py()
                base = base_spans(text)
                for kind in KINDS:
                    counts[kind].append(sum(k == kind for k, *_ in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                all_spans.append(_joined(base + added_spans(text, base, weights)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(digests, pa.string()), pa.array(all_spans, pa.string())],
                                             ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.mapInArrow(run, "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")


def masked(text: str, spans) -> str:
    """The text with each span replaced by its type in brackets; overlapping spans are replaced as one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join(out) + text[at:]


def mask_column(docs: DataFrame, text: Column, sample: int = SAMPLE) -> Column:
    """``text`` with all found spans masked, null staying null; the field is trained on ``docs``."""
    weights = train(training_windows(id_and_text(docs), sample))

    @F.arrow_udf("string")
    def mask(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            out = []
            for value in values:
                value = value.as_py()
                if value is not None and _SIGN.search(value):
                    base = base_spans(value)
                    value = masked(value, base + added_spans(value, base, weights))
                out.append(value)
            yield pa.array(out, pa.string())
            give_back()

    return mask(text)
