"""Sentence spans in any script, chosen as whole spans by a semi-Markov dynamic programme.

A text is cut at blank lines; headings, displayed formulas and list items are units of their own. In the
rest every place that could end a sentence is a candidate: end marks with their closing quotes and
brackets, with or without a space behind them, and spaces between Thai letters. The programme picks the
segmentation with the best sum of span scores. The score of a span from one candidate to another is the sum of
four weighted terms, none of which is a veto: how well its opening word opens a sentence (case, digit, script, a
quotation, what goes on behind one), how well its closing word and marks close one (known abbreviations, initials,
ordinals, numbers, omission dots), whether quotations and brackets balance within it, and its length. A span may hold any
number of candidates: starts within LONG characters are tried one by one, of those further back the best of
each balance state is kept, so time is linear in the text.

Defined results: null, empty and blank texts give no row; positions count code points; repeated rows give
repeated results unless made distinct; extra columns are ignored. No text is cut short, however long.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from skeinworks import runtime

LONG = 600
OVER = 0.002

# Abbreviations after which a sentence goes on, lower case, without the last point.
NEVER = frozenset(
    """
dr prof mr mrs ms st sr sra srta mme mlle mgr hr fr fig figs eq eqs tab sec sect ch chap vol pp pg ed eds
cf vs approx ca bzw nr abb bsp vgl evtl ggf inkl env art núm num cap pág pag aprox ej ex op resp viz
рис стр гл см табл им г-н проф др напр
ص د م أ डॉ पृ श्री प्रो
e.g i.e z.b d.h u.a p.ex p.ej т.е т.к
""".split()
)
# Abbreviations that end a sentence if what follows looks like a new one.
MAY_END = frozenset("etc usw al a.m p.m am pm inc ltd co jr bc ad т.д т.п др kg cm mm".split())
# Abbreviations only before a number.
BEFORE_NUMBER = frozenset("no p s n nos v c к".split())
ORDINAL_AFTER = frozenset("den dem der die das des am im vom zum zur ab bis seit beim jeder jede jedes ihr ihrem seinem".split())
SAID = ("यह", "ऐसा", "कह", "पूछ", "इस तरह", "बोल")

_blank = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
_item = re.compile(r"^[^\S\n]*(?:([-*•–·])|(\d{1,3}|[a-zA-Z])(\))|\((\d{1,3}|[a-z])\)|(\d{1,3})(\.))[^\S\n]+", re.M)
_marks = re.compile(r"[.!?…؟۔।॥。！？｡]+|[\"“”„«»‹›「」『』()（）\[\]]")
_word = re.compile(r"[^\s\"“”„«»()（）\[\]$,;:!?…]*$")
_thai = re.compile(r"[฀-๿]")
_thai_space = re.compile(r"(?<=[฀-๏๚-๿])\s+(?=[฀-๏๚-๿])")
_OPEN = {"«": 1, "‹": 1, "「": 1, "『": 1, "(": 2, "（": 2, "[": 2, "„": 1, "“": 1}
_CLOSE = {"»": 1, "›": 1, "」": 1, "』": 1, ")": 2, "）": 2, "]": 2, "”": 1}
_WIDE = frozenset("。！？｡")
_DANDA = frozenset("।॥؟۔")
_CONTINUES = frozenset(",;:—–-)，、；：）」』»”…")


def _is_wide(c: str) -> bool:
    return "぀" <= c <= "鿿" or "가" <= c <= "힯" or "＀" <= c <= "￯"


def _opens(block: str, at: int) -> int:
    """How what starts at this place looks: 2 a new sentence, 1 letters without case, 0 unclear, -1 a going on."""
    c = block[at]
    if c.isupper() or c in "¿¡$#":
        return 2
    if c.isdigit():
        return 2
    if c.islower():
        return -1
    if c in "\"“„«「『‘'(（[*_":
        k = at + 1
        while k < len(block) and (block[k].isspace() or block[k] in "\"“„«「『‘'(（[*_$¿¡"):
            k += 1
        if k < len(block) and block[k].islower():
            return 2 if block[k - 1] == "$" else (0 if c in "(（[" else 1)
        return 2
    if c in _CONTINUES:
        return -2
    return 1 if c.isalpha() else 0


@dataclass(frozen=True)
class Weights:
    """What each term of a span's score counts for; 0 leaves the term out."""

    opening: float = 1.0
    closing: float = 1.0
    balance: float = 1.0
    length: float = 1.0


WEIGHTS = Weights()
UNBALANCED = 6.0
TINY, TINY_COST, SHORT, SHORT_COST = 4, 3.0, 10, 0.3


def _opening(block: str, q: int, gap: bool, closer: str, last: str) -> float:
    """How well a sentence opens at q, behind the mark last and its closing characters."""
    c, looks = block[q], _opens(block, q)
    if looks == -2:
        return -12.0  # a comma, a dash, a closing mark
    quoted = bool(closer) and closer not in ")）]"
    if last in _WIDE:
        return -10.0 if closer and c in "とって的" else 1.0
    if quoted and last in "!?؟" and ("ऀ" <= c <= "ॿ" or block.startswith(SAID, q)):
        return -7.0  # the verb of saying follows its quotation
    if looks == -1:
        return -8.0 if closer else -3.0 if gap else -4.5
    if looks == 0:
        return -1.5 if gap else -3.5
    if c.isdigit():
        return 0.0 if gap else -0.5
    if not gap and c in "$(#'‘[*_„「『":
        return -3.5
    return 1.0


def _closing(block: str, start: int, t: int, e: int, gap: bool, closer: str) -> float:
    """How well a sentence closes with the word of start to t, end marks to e, and closing characters."""
    mark = block[t:e]
    last = mark[-1]
    if last in _WIDE or last in _DANDA:
        return 4.0 if gap or not closer or last in _WIDE else 1.0
    if last in "!?":
        return 3.5 if not closer else 2.0 if gap else 1.0
    if last == "…" or len(mark) > 1 and set(mark) == {"."}:
        return 1.0
    w = block[start:t]
    if "." in w and len(head := w.rpartition(".")[0]) > 1 and w[-1].isalpha() and (head[-1].isdigit() or "." not in head[-3:]):
        w = w.rpartition(".")[2]  # the last sentence ended without a space
    if closer:
        return 2.0 if gap else 1.0
    low = w.lower()
    if low in NEVER or (low.rpartition("-")[2] or low) in NEVER:
        return -8.0
    if not w:
        return 3.5  # after a formula or bracket
    if not gap:
        odd = len(w) < 2 or w[-1].isupper() and not w.isupper() or "." in w and not w[-1].isdigit() or w.isupper() and len(w) < 4
        return -8.0 if odd else 1.5 if w.isalpha() and len(w) > 3 else 0.4
    if low in BEFORE_NUMBER and len(low) > 1:
        return -0.2  # with a number behind it no end, with a capital one
    if low in MAY_END:
        return 1.0
    if len(w) == 1 and w.isalpha():
        if low == "д" and block[max(0, t - 4) : t - 1].strip().startswith("т"):
            return 1.0
        return 1.0 if _is_wide(w) else -8.0
    if w[-1].isdigit():
        if w.isdigit() and start == 0:
            return -8.0  # a number in front of the block
        if w.isdigit() and len(w) <= 2 and _word_before(block, start).lower() in ORDINAL_AFTER:
            return -8.0
        return 1.4
    if "." in w and low.replace(".", "").isalpha() and max(map(len, low.split("."))) <= 2:
        return -8.0
    return 4.0 if len(w) > 3 else 2.4 if len(w) > 1 else 1.2


def _word_before(block: str, at: int) -> str:
    """The word before at, or as many of its last letters as tell that it is in no list of ours."""
    while at and block[at - 1].isspace():
        at -= 1
    k = at
    while k and at - k < 12 and (block[k - 1].isalnum() or block[k - 1] == "_"):
        k -= 1
    return block[k:at]


def _word_start(block: str, t: int, known: tuple[int, int]) -> int:
    """Where the word that ends at t starts. known: end and start of an earlier word, which this one may go on from."""
    size = 24
    while True:
        lo = max(0, t - size)
        at = _word.search(block, lo, t).start()
        if at > lo or not lo:
            return at
        if lo <= known[0]:
            return known[1]  # nothing parts the two, so the words are one: no second look at its letters
        size *= 2


def span_score(place: list[int], closes: list[float], opens: list[float], state: list[int], i: int, j: int, weights: Weights) -> float:
    """The score of the span between places i and j; closes and opens hold their weights already."""
    size = place[j] - place[i]
    cost = 0.0 if state[i] == state[j] else UNBALANCED * weights.balance
    cost += weights.length * ((TINY_COST if size < TINY else SHORT_COST if size < SHORT else 0.0) + max(0, size - LONG) * OVER)
    return opens[i] + closes[j] - cost


def best_cuts(place: list[int], closes: list[float], opens: list[float], state: list[int], weights: Weights) -> list[int]:
    """The numbers of the places that bound the spans of the best sum of span_score."""
    count = len(place)
    apart, over = UNBALANCED * weights.balance, OVER * weights.length
    tiny, short = TINY_COST * weights.length, SHORT_COST * weights.length
    # start: the best sum of spans up to a place and its opening; most: the best of all starts so far.
    start, back, most = [0.0] * count, [0] * count, [0.0] * count
    far, far_all, gone = {}, -1, 0  # the best start more than LONG characters back: by balance state, of all; the first nearer one

    def at_far(i: int, k: int) -> bool:
        return k < 0 or start[i] + over * place[i] >= start[k] + over * place[k]

    for j in range(1, count):
        top, arg, pj, bj = -1e18, j - 1, place[j], state[j]
        while pj - place[gone] > LONG:
            if at_far(gone, far.get(state[gone], -1)):
                far[state[gone]] = gone
            if at_far(gone, far_all):
                far_all = gone
            gone += 1
        for i in range(j - 1, gone - 1, -1):
            if most[i] <= top:
                break  # no earlier start can be better
            size = pj - place[i]
            v = start[i]
            if state[i] != bj:
                v -= apart
            if size < SHORT:
                v -= tiny if size < TINY else short
            if v > top:
                top, arg = v, i
        for i in (far.get(bj, -1), far_all):
            if i >= 0:
                v = start[i] - (0.0 if state[i] == bj else apart) - (pj - place[i] - LONG) * over
                if v > top:
                    top, arg = v, i
        start[j], back[j] = top + closes[j] + opens[j], arg
        most[j] = max(most[j - 1], start[j])
    cuts, j = [count - 1], count - 1
    while j:
        j = back[j]
        cuts.append(j)
    cuts.reverse()
    return cuts


def _running(block: str, base: int, has_thai: bool, weights: Weights, out: list[tuple[int, int]]) -> None:
    """Spans of a block of running text, by the best sum of span scores."""
    # Of each place where a span may end: the place, how well one closes and the next opens there, the balance state.
    place, closes, opens, state = [0], [0.0], [0.0], [0]
    straight = depth = brackets = 0
    german = "„" in block
    n, skip, word = len(block), -1, (-1, 0)
    turns, turned = [], []  # where the balance state changes, and to what; only for spaces as ends
    wc, wo = weights.closing, weights.opening
    for m in _marks.finditer(block):
        t, e = m.span()
        if has_thai:
            turns.append(t)
            turned.append(straight + 2 * depth + 64 * brackets)
        if t < skip:
            continue
        c = block[t]
        if c == '"':
            straight ^= 1
            continue
        if c == "“" and german:
            depth -= 1 if depth else 0
            continue
        kind = _OPEN.get(c)
        if kind:
            if kind == 1:
                depth += 1
            else:
                brackets += 1
            continue
        kind = _CLOSE.get(c)
        if kind:
            if kind == 1:
                depth -= 1 if depth else 0
            else:
                brackets -= 1 if brackets else 0
            continue
        if e < n and c == "." and e - t == 1 and block[e].isdigit() and (t == 0 or not block[t - 1].isalpha()):
            continue  # a decimal
        p = e
        while p < n:  # closing quotes and brackets belong to the sentence
            x = block[p]
            if x == '"' and straight:
                straight = 0
            elif x == "“" and german and depth:
                depth -= 1
            elif x in "»”」』›" and depth:
                depth -= 1
            elif x in ")）]" and brackets:
                brackets -= 1
            elif x in "'’" and (p + 1 == n or block[p + 1].isspace()):
                pass
            elif x in "  " and p + 1 < n and block[p + 1] == "»" and depth:
                p += 1
                depth -= 1
            else:
                break
            p += 1
        skip = q = p
        while q < n and block[q].isspace():
            q += 1
        if q == n:
            continue  # the block's end is an end anyway
        closer = block[e:p].strip()
        start = t
        if c == "." and e - t == 1:
            start = _word_start(block, t, word)
            word = (t, start)
        place.append(p)
        closes.append(wc * _closing(block, start, t, e, q > p, closer))
        opens.append(wo * _opening(block, q, q > p, closer, block[e - 1]))
        state.append(straight + 2 * depth + 64 * brackets)
    if has_thai:
        known = set(place)
        turns.append(n)
        turned.append(straight + 2 * depth + 64 * brackets)
        spaces = [(m.start(), 4.0 * wc, 0.0, turned[bisect_left(turns, m.start())]) for m in _thai_space.finditer(block) if m.start() not in known]
        if spaces:
            place, closes, opens, state = map(list, zip(*sorted([*zip(place, closes, opens, state), *spaces])))
    if len(place) == 1:
        out.append((base, base + n))
        return
    place.append(n)
    closes.append(0.0)
    opens.append(0.0)
    state.append(straight + 2 * depth + 64 * brackets)
    cuts = best_cuts(place, closes, opens, state, weights)
    for i, j in zip(cuts, cuts[1:]):
        a, b = place[i], place[j]
        while a < b and block[a].isspace():
            a += 1
        while b > a and block[b - 1].isspace():
            b -= 1
        if a < b:
            out.append((base + a, base + b))


def _units(block: str) -> list[tuple[int, int, bool]]:
    """Parts of a block between blank lines: start, end, whether it is one unit by its form."""
    n = len(block)
    if block[0] == "#" or block.startswith("$$") and block.endswith("$$") and n > 4 and block.count("$$") == 2 or block.startswith("\\[") and block.endswith("\\]"):
        return [(0, n, True)]
    starts, kind_at_start = [], None
    for m in _item.finditer(block):
        kind = m.group(1) or m.group(3) or m.group(6) or "()"
        if m.start() == 0:
            if kind == "." and not _item.search(block, m.end()):
                continue  # a lone "1." may just as well open a paragraph
            kind_at_start = kind
            starts.append(0)
        elif kind == kind_at_start:
            starts.append(m.start())
        elif kind != ".":
            before = block[: m.start()].rstrip()
            if before[-1] in ".!?:;。：…" or before.endswith(("$$", ")", '"')):
                starts.append(m.start())
    if not starts:
        return [(0, n, False)]
    out = [(0, starts[0], False)] if starts[0] else []
    return out + [(a, b, True) for a, b in zip(starts, [*starts[1:], n])]


def sentences(text: str | None, weights: Weights = WEIGHTS) -> list[tuple[int, int]]:
    """Start and end of every sentence, in code points, without the white space around it."""
    if not text:
        return []
    out: list[tuple[int, int]] = []
    has_thai = bool(_thai.search(text))
    at = 0
    for lo, hi in [*((m.start(), m.end()) for m in _blank.finditer(text)), (len(text), len(text))]:
        part = text[at:lo]
        lead = len(part) - len(part.lstrip())
        block = part.strip()
        if block:
            base = at + lead
            for a, b, whole in _units(block):
                piece = block[a:b]
                shift = len(piece) - len(piece.lstrip())
                piece = piece.strip()
                if not piece:
                    continue
                if whole:
                    out.append((base + a + shift, base + a + shift + len(piece)))
                else:
                    _running(piece, base + a + shift, has_thai, weights, out)
        at = hi
    return out


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, starts, ends = [], [], []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for s, e in sentences(text):
                ids.append(i)
                starts.append(s)
                ends.append(e)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["doc_id", "char_start", "char_end"])


def split_sentences(documents: DataFrame) -> DataFrame:
    """doc_id, char_start, char_end of every sentence. documents: doc_id bigint, text string. Needs no shuffle."""
    runtime.ship_package(documents.sparkSession)
    return documents.select("doc_id", "text").filter("text is not null").mapInArrow(_split, "doc_id long, char_start long, char_end long")


def p8_found(spark, sf_dir: str) -> DataFrame:
    return split_sentences(runtime.table(spark, sf_dir, "documents"))
