"""Sentence units in many languages and scripts by semi-Markov dynamic programming.

Blocks first: blank lines, headings, list items and fenced code bound units.
Within a paragraph every end mark followed by space (or any mark of scripts
without spaces, or a space between Thai letters) is a candidate. The best
sequence of whole spans between candidates wins; a span scores by its length,
its opening, its closing with what follows, and the balance of quotations and
brackets in it.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import deque
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomgrid import storage

# Abbreviations of the languages covered, lower case, without the last dot.
#: Stand before a name and never end a sentence.
TITLES = frozenset("dr prof mr mrs ms st rev hon gen col sgt capt lt sr sra srta dra lic ing hr fr frl m mm mme mlle me г-н г-жа акад доц डॉ श्री प्रो د أ م".split())
#: Stand before a number.
NUMBERED = frozenset("no nos nr nrn num núm fig figs abb abs sec sect kap chap cap pág págs pag pp vol bd art ch eq tab taf z zif ziff § рис гл стр табл п пп ст № с vgl".split())
#: Stand within a sentence.
INNER = frozenset(
    "approx ca env aprox i.e e.g cf vs viz al resp bzw z.b d.h u.a s.o s.u inkl exkl evtl ggf sog gem lt zzgl abzgl max min est ex ej c.-à-d càd "
    "ок тыс млн млрд т.е т.к см ср напр им ул jan feb mar apr jun jul aug sep sept oct nov dec janv févr avr juil déc ene abr ago dic".split()
)
#: May end a sentence or stand within it.
EITHER = frozenset("etc usw usf u.s u.k u.n e.u inc ltd co corp llc gmbh jr a.m p.m am pm г гг д др пр т.д т.п и.т.д uvm bros dept".split())
MONTHS = frozenset(
    "januar februar märz april mai juni juli august september oktober november dezember jänner jan feb mär apr jun jul aug sep okt nov dez".split()
)
ORDINAL_BEFORE = frozenset("am der dem den die das des vom zum beim im ab bis seit und oder ein eine einen einem jeder jeden jedem im".split())

_THAI = "ก-\u0e3aเ-\u0e4e"
_CLOSERS = "\"'”’»›)\\]}」』）】》〉”“"
_CANDIDATE = re.compile(
    rf"(?P<wide>[。！？｡．]+[。！？!?…]*[{_CLOSERS.replace('“', '')}]*)"
    rf"|(?P<mark>(?<![.!?…।॥؟۔։])[.!?…।॥؟۔։]++(?:[  ][»›]|[{_CLOSERS}])*)(?=\s|$)"
    rf"|(?P<thai>(?<=[{_THAI}])(?=\s+(?:>\s*)?[{_THAI}]))"
)
_PAIRS = {"“": "”", "«": "»", "‹": "›", "(": ")", "[": "]", "（": "）", "「": "」", "『": "』", "《": "》", "【": "】"}
_OPENS = {v: k for k, v in _PAIRS.items()}
_OPEN = frozenset([*_PAIRS, "„", "‚", "\"", "¿", "¡", "'", "‘"])
_TRACKED = re.compile("[“”„«»‹›()\\[\\]（）「」『』《》【】\"]")
#: Characters at which a word begins, white space aside.
_BREAKS = frozenset("\"“”„«»()（）[]「」")
#: Opening marks that may stand before the first letter of a sentence.
_OPENERS = "\"'“„«‹([¿¡「『（‘"
_FENCE = re.compile(r"[ \t]*(`{3,}|~{3,})")
_HEADING = re.compile(r"[ \t]{0,3}(?:#{1,6}[ \t]+\S|={2,6}[ \t]*[^\s=]|h[1-6]\.[ \t]+\S)")
_UNDERLINE = re.compile(r"[ \t]*(?:={3,}|-{3,})[ \t]*$")
_BULLET = re.compile(r"[ \t]*(?:>[ \t]*)*[-*+•‣◦▪·–][ \t]+\S")
_NUMBER = re.compile(r"[ \t]*(?:>[ \t]*)*(?:(\d{1,18})[.)]|[a-zA-Z]\)|#)[ \t]+\S")
_QUOTE = re.compile(r"[ \t]*(?:>[ \t]*)+")

#: Scores of the parts; a span of average looks scores above zero, so cutting pays where nothing speaks against it.
END, WEAK, NEVER, BALANCE, OPENING, LOWER, SHORT, LONG_FROM, LONG = 3.0, 1.0, -8.0, -8.0, 0.5, -0.5, -0.5, 400, 0.004


def _word_before(text: str, at: int) -> str:
    """The word that ends at `at`; empty after white space, a quotation mark or a bracket."""
    begin = at
    while begin and not (text[begin - 1].isspace() or text[begin - 1] in _BREAKS):
        begin -= 1
    return text[begin:at]


def _back(text: str, at: int, also: str = "") -> int:
    """The end of what stands before `at` without white space and the characters of `also`."""
    while at and (text[at - 1].isspace() or text[at - 1] in also):
        at -= 1
    return at


def _ahead(text: str, at: int, also: str = "") -> int:
    """The place of the first character from `at` on that is neither white space nor one of `also`."""
    while at < len(text) and (text[at].isspace() or text[at] in also):
        at += 1
    return at


_LETTERS = re.compile(r"\w*")
_CLOCK = re.compile(r"(?:^|[\s\d])[ap]\.?\s?m$")
_LIST_END = re.compile(r"\bт\.\s*[дп]$")
_DOTTED = re.compile(r"(?:\w\.)+\w")
_DASH = re.compile(r"[—–-]\s")


def _dot(text: str, at: int, after: int) -> float:
    """Score of ending a sentence at the single dot at `at`; `after` is the place of what follows."""
    before = _word_before(text, at)
    word = before.lower().lstrip("([{¿¡'‘’-–—")
    first = text[after : after + 1]
    lower, digit = first.islower(), first.isdigit()
    if word.isdigit():
        p = _word_before(text, _back(text, at - len(before))).lower()
        following = _LETTERS.match(text, after).group().lower()  # type: ignore[union-attr]
        if following in MONTHS or (p in ORDINAL_BEFORE and len(word) <= 2 and first.isalpha()):
            return NEVER
        return WEAK if lower else END
    if word in NUMBERED and digit:
        return NEVER
    if word in TITLES and not lower and first:
        return NEVER
    if word in INNER:
        return NEVER
    tail = text[max(0, at - 6) : at].lower()
    if _CLOCK.search(tail):
        return NEVER if lower else END
    if word in EITHER:
        if _LIST_END.search(tail) or word not in ("д", "др"):
            return NEVER if lower or digit else END
    if len(word) == 1 and word.isalpha():
        return NEVER
    if lower and _DOTTED.fullmatch(word):
        return NEVER
    if word in NUMBERED and word not in ("no", "z", "art", "с", "п", "ст", "m"):
        return -END
    return WEAK if lower else END


class Marks:
    """Places of quotation marks and brackets of a text."""

    def __init__(self, text: str):
        self.text, self.at = text, {}
        for m in _TRACKED.finditer(text):
            self.at.setdefault(m.group(), []).append(m.start())

    def last(self, mark: str, before: int) -> int:
        """The last place of a mark before a place, -1 for none."""
        places = self.at.get(mark, [])
        k = bisect_left(places, before)
        return places[k - 1] if k else -1

    def reported(self, end: int) -> bool:
        """Whether the quotation that closes at `end` opened where a sentence starts, so that a report of who said it may follow."""
        closer = self.text[end - 1]
        begin = self.last(_OPENS.get(closer, closer), end - 1)
        if closer in "“”":
            begin = max(begin, self.last("„", end - 1))
        if begin < 0 or closer in ")]）]】":
            return False
        ahead = _back(self.text, begin, ">")
        return not ahead or self.text[ahead - 1] in ".!?…。！？।॥؟۔" + _CLOSERS


def _closing(kind: str, mark: str, marks: Marks, at: int, end: int) -> float:
    """Score of the closing at a candidate whose mark begins at `at` and ends at `end`."""
    if kind == "thai":
        return END
    text = marks.text
    rest = _ahead(text, end, ">")
    bare = mark.rstrip(_CLOSERS + "  ›»")
    closed = len(bare) < len(mark)
    next_char = text[rest : rest + 1]
    after = _ahead(text, rest, _OPENERS) if next_char in _OPENERS else rest
    first = text[after : after + 1]
    if closed and next_char and marks.reported(end) and not (next_char.isupper() or next_char in _OPEN or next_char.isdigit()):
        return NEVER
    if kind == "wide":
        if closed and next_char in ("と", "て", "、", "，"):
            return NEVER
        return END
    if closed and first.islower() and next_char not in _OPEN:
        inside = mark[len(bare) :].strip()
        return NEVER if inside[:1] != ")" or bare[-1:] == "." else WEAK
    if closed and _DASH.match(text, rest):
        return NEVER
    if bare == ".":
        return _dot(text, at, after)
    if bare in ("...", "…", "....") or set(bare) <= {".", "…"}:
        return -END if first.islower() else END
    return WEAK if first.islower() else END


def _straddled(text: str, cuts: list[int]) -> list[int]:
    """How many pairs of quotation marks or brackets each cut lies inside of; marks without a partner count for nothing.

    A straight quote opens after space or an opening bracket, else it closes.
    """
    stacks: dict[str, list[int]] = {}
    change = [0] * (len(cuts) + 1)
    for m in _TRACKED.finditer(text):
        c, at = m.group(), m.start()
        if c == "\"":
            opens = at == 0 or text[at - 1].isspace() or text[at - 1] in "([{:—–-（「"
            kind = c
        elif c == "„":
            opens, kind = True, c
        elif c in "“”" and stacks.get("„"):
            opens, kind = False, "„"
        elif c in _PAIRS:
            opens, kind = True, c
        else:
            opens, kind = False, _OPENS[c]
        stack = stacks.setdefault(kind, [])
        if opens:
            stack.append(at)
        elif stack:
            begin = stack.pop()
            change[bisect_right(cuts, begin)] += 1
            change[bisect_right(cuts, at)] -= 1
            if kind == "\"":
                stack.clear()
    return list(accumulate(change[:-1]))


def _opening(text: str, start: int) -> float:
    c = text[start : start + 1]
    if c in "»”’)]」』）,;:、，" and c:
        return BALANCE
    return LOWER if c.islower() else OPENING


def _best_cuts(cuts: list[int], first: list[int], opening: list[float], close: list[float]) -> list[int]:
    """For each cut the one where the best last span before it begins.

    A span scores its opening, its closing and its length: short ones lose
    SHORT, long ones LONG for each character over LONG_FROM. So the best begin
    among far cuts is a running maximum, among near ones that of a sliding
    window, and the time is linear in the cuts. Ties go to the nearest begin.
    """
    best, way = [0.0], [0]
    window: deque[tuple[float, int]] = deque()
    far, near, far_best = 0, 0, (float("-inf"), 0)
    for j in range(1, len(cuts)):
        end = cuts[j]
        while near < j and end - first[near] >= 4:
            value = best[near] + opening[near]
            while window and window[-1][0] <= value:
                window.pop()
            window.append((value, near))
            near += 1
        while far < near and end - first[far] > LONG_FROM:
            value = best[far] + opening[far] + LONG * first[far]
            if value >= far_best[0]:
                far_best = value, far
            if window and window[0][1] == far:
                window.popleft()
            far += 1
        top, at = far_best[0] - (end - LONG_FROM) * LONG, far_best[1]
        if window and window[0][0] >= top:
            top, at = window[0]
        for i in range(near, j):
            if best[i] + opening[i] + SHORT >= top:
                top, at = best[i] + opening[i] + SHORT, i
        best.append(top + close[j])
        way.append(at)
    return way


def paragraph(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """Spans of the sentences of text[a:b], which holds no blank line and no other block."""
    part = text[a:b]
    marks = Marks(part)
    last = len(part.rstrip())
    cuts, close = [0], [0.0]
    for m in _CANDIDATE.finditer(part):
        if m.end() < last:
            cuts.append(m.end())
            close.append(_closing(m.lastgroup or "", m.group(), marks, m.start(), m.end()))
    cuts.append(last)
    close.append(END)
    if len(cuts) == 2:
        return [(a, a + last)]
    starts = []
    for c in cuts[:-1]:
        s = c
        while s < last and part[s].isspace():
            s += 1
        starts.append(s)
    inside = _straddled(part, cuts)
    close = [c + BALANCE * n for c, n in zip(close, inside)]
    plain = [_QUOTE.match(part, s) for s in starts]
    first = [m.end() if m and m.end() < last else s for m, s in zip(plain, starts)]
    opening = [_opening(part, s) for s in first]
    way = _best_cuts(cuts, first, opening, close)
    spans, j = [], len(cuts) - 1
    while j > 0:
        i = way[j]
        spans.append((a + starts[i], a + cuts[j]))
        j = i
    return spans[::-1]


def _lines(text: str) -> Iterator[tuple[int, int]]:
    start = 0
    for m in re.finditer(r"\r\n|[\n\r\u2028\u2029\x0b\x0c]", text):
        yield start, m.start()
        start = m.end()
    yield start, len(text)


def _numbered(line: str, numbers: set[int]) -> bool:
    """Whether a line is an item with a number or letter. A number of four digits or more counts next to the one before or after it, else it is a year or an amount."""
    m = _NUMBER.match(line)
    return bool(m) and not (m[1] and len(m[1]) > 3 and numbers.isdisjoint((int(m[1]) - 1, int(m[1]) + 1)))


def blocks(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whole) of the blocks of a text; a whole one is a single unit, others are paragraphs."""
    out: list[tuple[int, int, bool]] = []
    open_at: int | None = None  # a paragraph in progress
    end_at, open_line, in_list, fence, fence_at = 0, -1, False, "", 0
    lines = list(_lines(text))
    fences = [bool(_FENCE.match(text, s, e)) for s, e in lines]
    last = {text[s:e].strip()[:3]: k for k, (s, e) in enumerate(lines) if fences[k]}  # the last fence of each kind
    numbers = {int(m[1]) for s, e in lines if (m := _NUMBER.match(text, s, e)) and m[1]}

    def close() -> None:
        nonlocal open_at
        if open_at is not None:
            out.append((open_at, end_at, False))
            open_at = None

    for k, (s, e) in enumerate(lines):
        line = text[s:e]
        if fence:
            if line.strip().startswith(fence) and not line.strip().strip(fence[0]):
                out.append((fence_at, e, True))
                fence = ""
            continue
        if fences[k] and (mark := _FENCE.match(line)):
            tick = mark.group(1)[:3]
            if last[tick] > k:
                close()
                fence, fence_at, in_list = tick, s, False
                continue
        if not line.strip():
            close()
            in_list = False
            continue
        if _HEADING.match(line):
            close()
            out.append((s, e, True))
            in_list = False
            continue
        fresh = open_at is None
        if (fresh or in_list or text[_back(text, end_at) - 1] == ":") and (_BULLET.match(line) or _numbered(line, numbers)):
            close()
            out.append((s, e, True))
            in_list = True
            continue
        if in_list:
            out.append((s, e, False))
            continue
        if fresh and k + 1 < len(lines) and _UNDERLINE.match(text[lines[k + 1][0] : lines[k + 1][1]]):
            open_at, end_at, open_line = s, e, k
            continue
        if not fresh and open_line == k - 1 and _UNDERLINE.fullmatch(line):
            out.append((open_at, e, True))  # type: ignore[arg-type]
            open_at = None
            continue
        if fresh:
            open_at, open_line = s, k
        end_at = e
    if fence:
        out.append((fence_at, len(text), True))
    close()
    return out


def units(text: str | None) -> list[tuple[int, int]]:
    """Start and end of every unit of a text, without surrounding white space; none for null and blank texts."""
    if not text:
        return []
    found: list[tuple[int, int]] = []
    for a, b, whole in blocks(text):
        while a < b and text[a].isspace():
            a += 1
        while b > a and text[b - 1].isspace():
            b -= 1
        if a < b:
            found += [(a, b)] if whole else paragraph(text, a, b)
    return found


def split(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, start_at, end_at) of the sentence units of every document.

    Offsets count code points from 0, end_at is exclusive. Null, empty and
    blank texts have no units, repeated rows give theirs again, extra columns
    are ignored. A document is one row, so nothing is shuffled.
    """
    schema = f"{doc_id} long, start_at int, end_at int"

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids, starts, ends = [], [], []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for s, e in units(t):
                    ids.append(d)
                    starts.append(s)
                    ends.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[doc_id, "start_at", "end_at"])

    return storage.spread(documents.select(F.col(doc_id).cast("long").alias(doc_id), text)).mapInArrow(batches, schema)
