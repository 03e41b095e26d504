"""Personal data: base patterns, and spans that a character tagger adds.

Four kinds: email, ip, card, phone.  The base patterns (``base_spans``) are matched over whole texts.
The tagger (``crf.Tagger``: bidirectional LSTM, CRF transitions) learns from windows of the corpus
whose base spans are its labels, and from copies of them with the span, or other data in its place,
respelled as people respell such data (bracketed dots and at signs, other separators, no plus
sign), which no base pattern takes.  It adds spans that are meant as data of a kind:

* A text is covered by windows of ``WINDOW`` places, a new one each ``STEP`` places.  Windows that
  hold none of the marks without which no span is accepted (a digit, an at sign, a bracketed
  "at") are passed over: whatever they decoded to would be refused.
* Each window is decoded by itself.  Spans are then reconciled over the whole text: spans cut by a window's
  border are joined with what the next window has there, or dropped in favour of it; a span is
  accepted if it is well formed once its separators are put right (``accepted``: a card passes Luhn, an
  address has four parts up to 255, ...); of accepted spans that overlap, the set with the greatest total
  margin over "no data" stays, found exactly.  Spans that overlap a base span are dropped.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from layerworks.llm.common import text_slices
from layerworks.llm.crf import Tagger

KINDS = ("email", "ip", "card", "phone")
WINDOW, STEP, BATCH = 96, 48, 512
PER_KIND = 300  # windows to learn from for each kind, and as many without data
EXAMPLES = 3600  # to learn from, with respelled copies
SHARES = (0.4, 0.2, 0.2, 0.2)  # of the kinds among data put in

# Base patterns in forms that take time in proportion to the text: repeats give nothing back,
# and a run of digits is entered at its start only, where its leftmost match is.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_MARK = re.compile(r"[\d@＠]|[\[({<]\s{0,3}at\s{0,3}[\])}>]", re.IGNORECASE)
_AT = re.compile(r"\s?[\[({<]\s{0,3}at\s{0,3}[\])}>]\s?|\s?@\s?", re.IGNORECASE)
_DOT = re.compile(r"\s?[\[({<]\s{0,3}(?:dot|\.)\s{0,3}[\])}>]\s?|\s?\.\s?", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _is_ip(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match's local part is the run of its characters before an at sign, from the last match's end on."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; places are code points."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if _is_ip(m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def accepted(kind: str, value: str) -> bool:
    """Whether a decoded span is well formed data of its kind."""
    value = unicodedata.normalize("NFKC", value)
    digits = "".join(c for c in value if c.isdecimal())
    if not digits.isascii():
        digits = "".join(str(unicodedata.decimal(c)) for c in digits)
    if kind == "email":
        plain = _DOT.sub(".", _AT.sub("@", value))
        return plain.count("@") == 1 and list(_emails(plain)) == [(0, len(plain))]
    if kind == "ip":
        plain = _DOT.sub(".", value)
        return bool(_IP.fullmatch(plain)) and _is_ip(plain.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and bool(re.fullmatch(r"\d(?:[ ._/·-]{0,3}\d)*", value))
    between = re.findall(r"[^0-9]", value[1:-1])
    return 9 <= len(digits) <= 15 and (value[0] in "+(" or value[:2] == "00" or len(between) >= 2) and bool(re.fullmatch(r"[+(]?[\d ().\-/]*\d", value))


# Character classes: letters of either case, punctuation and white space each by itself, all
# digits as one, other letters as one, all else as one; 0 is past the text's end.
_CLASS = {c: i + 1 for i, c in enumerate("abcdefghijklmnopqrstuvwxyz !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\n\t")}
_DIGITS, _LETTERS, _ELSE = len(_CLASS) + 1, len(_CLASS) + 2, len(_CLASS) + 3
CLASSES = _ELSE + 1


def char_class(c: str) -> int:
    c = unicodedata.normalize("NFKC", c).lower()
    return _CLASS.get(c) or (_DIGITS if c.isdecimal() else _LETTERS if c.isalpha() else _ELSE)


class _Classes(dict):
    def __missing__(self, c: str) -> int:
        self[c] = char_class(c)
        return self[c]


_CLASS_OF = _Classes()


def classes(window: str) -> list[int]:
    return [_CLASS_OF[c] for c in window[:WINDOW]] + [0] * (WINDOW - len(window))


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a mark."""
    starts = {s for m in _MARK.finditer(text) for s in (m.start() // STEP * STEP, m.start() // STEP * STEP - STEP) if s >= 0}
    return sorted(starts)


# Tags: 0 none, then for each kind one for its first place and one for those that follow.
def _transitions() -> tuple[np.ndarray, np.ndarray]:
    tags = 2 * len(KINDS) + 1
    allowed, first = np.ones((tags, tags), bool), np.ones(tags, bool)
    for k in range(len(KINDS)):
        inside = 2 * k + 2
        allowed[:, inside], first[inside] = False, False
        allowed[[inside - 1, inside], inside] = True
    return allowed, first


def tags_of(spans: list[tuple[str, int, int]], start: int, length: int) -> list[int]:
    """Tags of the window from ``start``; where kinds overlap, the one listed first."""
    out = [0] * length
    for kind, a, b in reversed(spans):
        a, b = max(a - start, 0), min(b - start, length)
        if a < b:
            tag = 2 * KINDS.index(kind) + 1
            out[a:b] = [tag] + [tag + 1] * (b - a - 1)
            if b < length and out[b] and out[b] % 2 == 0:
                out[b] -= 1
    return out


def respelled(kind: str, value: str, rng: np.random.Generator) -> str:
    """``value`` as it might be written to be read by people only."""
    pick = lambda *forms: forms[int(rng.integers(len(forms)))]
    digits = "".join(_DIGIT.findall(value))
    if kind == "email":
        at, dot = pick(("(at)", "."), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" @ ", "."), ("{at}", "."), (" [at] ", " [dot] "), ("@", "[.]"), ("＠", "."))
        local, _, domain = value.rpartition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return value.replace(".", pick("[.]", "(.)", " . ", "[dot]", " [.] "))
    if kind == "card":
        gap = pick(".", "/", "_", "  ", " - ", "·")
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{digits[:-10]} {a} {b} {c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}", f"({a}) {b} {c}", f"+{digits[:-10] or 1}/{a}/{b}{c}")


def plain_number(rng: np.random.Generator) -> str:
    """Digits that are no personal data: amounts, dates, times, versions, identifiers."""
    n = lambda low, high: int(rng.integers(low, high))
    forms = (
        f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}", f"{n(0, 24)}:{n(10, 60)}:{n(10, 60)}",
        f"{n(0, 20)}.{n(0, 30)}.{n(0, 99)}", f"{n(0, 10**6)}", f"{n(10**11, 10**12)}", f"#{n(1, 10**5)}", f"{n(1, 100)}%", f"${n(1, 10**4)}.{n(10, 100)}", f"{n(1, 10**3)} {n(1, 10**3)}", f"0x{n(0, 1 << 60):x}",
        f"{n(1900, 2030)}-{n(1900, 2030)}", f"{n(1, 300)}/{n(1, 300)}", f"@{'abcdefgh'[: n(2, 8)]}",
    )
    return forms[n(0, len(forms))]


def labelled_windows(docs: DataFrame, text: str, per_kind: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(window, its base spans, cut at its borders): for each kind, and for windows with a mark but
    no span, the ``per_kind`` distinct windows of smallest hash; bounded by 5 * per_kind windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole):
                out: dict[tuple, None] = {}
                for t in batch.column("text").to_pylist():
                    if not t or not _MARK.search(t):
                        continue
                    spans = sorted(base_spans(t), key=lambda s: s[1])
                    at = 0
                    for start in window_starts(t):
                        while at < len(spans) and spans[at][2] <= start - 2 * WINDOW:
                            at += 1
                        here = []
                        for kind, a, b in spans[at:]:
                            if a >= start + WINDOW:
                                break
                            if b > start:
                                here.append((kind, max(a - start, 0), min(b - start, WINDOW)))
                        out[here[0][0] if here else "", t[start : start + WINDOW], ",".join(f"{k}:{a}:{b}" for k, a, b in here)] = None
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(3)], names=["kind", "window", "spans"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "kind string, window string, spans string").dropDuplicates(["window"])
    least = Window.partitionBy("kind").orderBy(F.xxhash64("window"), "window")
    rows = found.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= per_kind).orderBy("kind", "_n").collect()
    parse = lambda s: [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in s.split(",") if x)]
    return [(r.window, parse(r.spans)) for r in rows]


def another(kind: str, rng: np.random.Generator) -> str:
    """Other data of a kind, in a form that its base pattern takes."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda low, high: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(low, high)))
    if kind == "email":
        local = name(1, 10) + rng.choice(["", ".", "_", "-", "+"]) + rng.choice(["", name(1, 9), digits(2), digits(4)])
        return f"{local.rstrip('.')}@{'.'.join(name(2, 9) + rng.choice(['', digits(1)]) for _ in range(rng.integers(1, 4)))}.{name(2, 5)}"
    if kind == "ip":
        return ".".join(map(str, rng.integers(0, 256, 4)))
    if kind == "card":
        body = digits(int(rng.choice([12, 14, 15, 15, 15, 18])))
        return next(body + str(c) for c in range(10) if luhn(body + str(c)))
    return f"+{rng.integers(1, 400)} {rng.choice(['({}) {}-{}', '{} {} {}', '{}-{}-{}'])}".format(digits(3), digits(3), digits(4))


def examples(windows: list[tuple[str, list[tuple[str, int, int]]]], total: int = EXAMPLES, seed: int = 19) -> tuple[np.ndarray, np.ndarray]:
    """Character classes and tags of the windows, and of copies of them, ``total`` in all, whose first
    span that is not cut gives way to itself or other data of any kind, respelled or not, or to a plain number."""
    rng = np.random.default_rng(seed)
    texts, tags = [w for w, _ in windows], [tags_of(spans, 0, len(w)) for w, spans in windows]
    places = [(w, spans, s) for w, spans in windows for s in spans[:1] if s[1] > 0 and s[2] < len(w) and not any(x < s[2] and y > s[1] for _, x, y in spans[1:])]
    while places and len(texts) < total:
        window, spans, (kind, a, b) = places[int(rng.integers(len(places)))]
        what, new = rng.random(), window[a:b]
        if what < 0.25:
            new, put = plain_number(rng), []
        else:
            if rng.random() < 0.8:
                kind = rng.choice(KINDS, p=SHARES)
                new = another(kind, rng)
            new = respelled(kind, new, rng) if what < 0.85 else new
            put = [(kind, a, a + len(new))]
        further = len(new) - (b - a)
        moved = put + [(k, x + further, y + further) for k, x, y in spans if x >= b] + [s for s in spans if s[2] <= a]
        texts.append((window[:a] + new + window[b:])[:WINDOW])
        tags.append(tags_of(sorted(moved, key=lambda s: KINDS.index(s[0])), 0, len(texts[-1])))
    return np.array([classes(t) for t in texts]), np.array([t[:WINDOW] + [0] * (WINDOW - len(t)) for t in tags])


def fit(docs: DataFrame, text: str = "text", per_kind: int = PER_KIND, epochs: int = 7) -> Tagger | None:
    """A tagger learned from at most 5 * ``per_kind`` windows of ``docs`` and respelled copies of
    them; None where no window has a base span, so that there is nothing to learn."""
    windows = labelled_windows(docs, text, per_kind)
    if not any(spans for _, spans in windows):
        return None
    tagger = Tagger(CLASSES, *_transitions())
    tagger.fit(*examples(windows), epochs=epochs)
    return tagger


def spans_in(tags: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(kind's number, start, end, margin over no data) of a window's tags."""
    out = []
    for a in np.flatnonzero(tags % 2 == 1):
        b = int(a) + 1
        while b < len(tags) and tags[b] == tags[a] + 1:
            b += 1
        margin = scores[np.arange(a, b), tags[a:b]] - scores[a:b, 0]
        out.append((int(tags[a]) // 2, int(a), b, float(margin.sum())))
    return out


def reconciled(text: str, found: list[tuple[int, int, int, float, bool, bool]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that stay of all windows': (kind's number, start, end, margin, cut at its start,
    cut at its end)."""
    closed: dict[tuple[int, int, int], float] = {}
    open_: list[tuple] = []
    for span in sorted(found, key=lambda s: (s[1], s[2])):
        kind, a, b, margin, left, right = span
        if left:  # goes on from a span that the window before has cut, if that one reaches into it
            for other in open_:
                if other[0] == kind and other[1] < a < other[2]:
                    a, margin, left = other[1], max(margin, other[3]), other[4]
                    break
        if right:
            open_.append((kind, a, b, margin, left))
            open_ = [o for o in open_ if o[2] > a - WINDOW]
        elif not left:
            closed[kind, a, b] = max(margin, closed.get((kind, a, b), margin))
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = [a for a, _ in taken], np.maximum.accumulate([b for _, b in taken]) if taken else []
    good = []
    for (kind, a, b), margin in closed.items():
        while b > a and text[b - 1] in " .,;:-\n\t":
            b -= 1
        while a < b and text[a] in " .,;:-\n\t":
            a += 1
        before = np.searchsorted(starts, b) - 1 if taken else -1
        if a < b and margin > 0 and not (before >= 0 and ends[before] > a) and accepted(KINDS[kind], text[a:b]):
            good.append((b, a, kind, margin))
    good.sort()
    # the heaviest set without overlaps: best[i] is the most that the first i spans can weigh
    finish, best, choice = [g[0] for g in good], [0.0], []
    for b, a, _, margin in good:
        before = int(np.searchsorted(finish, a, "right"))
        take = best[before] + margin > best[-1]
        choice.append(before if take else -1)
        best.append(max(best[-1], best[before] + margin))
    out, i = [], len(good)
    while i:
        if choice[i - 1] >= 0:
            out.append((KINDS[good[i - 1][2]], good[i - 1][1], good[i - 1][0]))
            i = choice[i - 1]
        else:
            i -= 1
    return out


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], tagger: Tagger) -> list[list[tuple[str, int, int]]]:
    """For each text the spans that the tagger adds to its base spans."""
    found: list[list[tuple]] = [[] for _ in texts]
    places = ((i, s) for i, t in enumerate(texts) if _MARK.search(t) for s in window_starts(t))
    while some := [p for p, _ in zip(places, range(BATCH), strict=False)]:
        tags, scores = tagger.decode(np.array([classes(texts[i][s : s + WINDOW]) for i, s in some]))
        for (i, s), t, score in zip(some, tags, scores, strict=True):
            size = len(texts[i])
            for kind, a, b, margin in spans_in(t[: size - s], score):
                found[i].append((kind, a + s, b + s, margin, a == 0 and s > 0, b == WINDOW and s + WINDOW < size))
    return [reconciled(t, f, b) if f else [] for t, f, b in zip(texts, found, base, strict=True)]


def find(df: DataFrame, tagger: Tagger | None, text: str = "text", keep_text: bool = True) -> DataFrame:
    """The rows of ``df`` with ``spans``: an array of (kind, start, end, base, value), by kind as
    listed, then start; ``base`` tells the patterns' spans from the tagger's (none without a tagger).

    A null or empty text has no spans; repeated rows stay, each with the same spans; a
    column of the name ``spans`` is replaced; an empty table stays empty.  Whole texts of any length
    are read; where spans of different kinds begin alike, both base spans stay."""
    rows = df.select(*[c for c in df.columns if c != "spans"])
    kept = [c for c in rows.columns if keep_text or c != text]
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, text):
                texts = [t or "" for t in batch.column(text).to_pylist()]
                base = [base_spans(t) for t in texts]
                more = added_spans(texts, base, tagger) if tagger else [[]] * len(texts)
                spans = []
                for t, b, m in zip(texts, base, more, strict=True):
                    every = sorted([(*s, True) for s in b] + [(*s, False) for s in m], key=lambda s: (KINDS.index(s[0]), s[1]))
                    spans.append([{"kind": k, "start": x, "end": y, "base": is_base, "value": t[x:y]} for k, x, y, is_base in every])
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(spans, pa.list_(item))], names=[*kept, "spans"])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name in kept)
    return rows.mapInArrow(run, schema + "spans array<struct<kind: string, start: long, end: long, base: boolean, value: string>>")
