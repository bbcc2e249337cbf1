"""Defective question and answer pairs: noisy labelling functions under an expectation-maximization label model.

Each row is turned into votes (+ defect, - none, 0 abstains) of the labelling functions of FUNCTIONS. Each function
looks at another trace of a defect and none is made of others, so they contradict one another on many rows. A
truncated last step and a truncated final answer leave different traces and are two latent classes. The votes of all rows are
counted by pattern for each class (three to the number of its functions at most, so the
tables are small whatever the input), and for each a two-class model with a table of vote probabilities for each
function is fitted to the pattern counts by EM, from the functions' expected hit and false rates as a weak prior. A row
keeps every defect whose posterior exceeds its cutoff. The cutoffs are chosen by answer_calibration on pairs labelled
by construction, half of them held out, and held to those and to a hand-labelled fixture in tests/llm.

Unfinished last steps are told from those that only lack a full stop by how the corpus goes on after the
same words: for the last words of such a step (1 to 4, in scripts without spaces 4 to 8 characters), the
share of their occurrences that stand directly before an end mark or end a step that is not the last one.
Longer runs count over shorter ones as far as they are seen; places before a bracket do not count. Last
steps without an end mark do not vouch for their ending, so a break that recurs stays one, and shares do not
depend on the size of the corpus. Only runs that some step asks for are counted, told by a filter of at most
FILTER_BITS that is broadcast; a full filter only costs a larger shuffle.

Defined results: null fields count as blank, null steps as missing; a row delivered twice gives one result; rows with
a null id give none; 'wrong problem' as final answer is a valid outcome; an empty table gives an empty
frame; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeinworks import runtime
from skeinworks.llm import near_dups
from skeinworks.llm import textops as tx
from skeinworks.llm.answer_cutoffs import CALIBRATED

DEFECTS = ("refusal", "copied_question", "other_language", "truncated_answer", "empty_answer")
# Latent classes: their defect, and each labelling function's expected share of + votes in the class and outside it.
FUNCTIONS = {
    "refusal": ("refusal", {"says_it_cannot": (0.9, 0.01), "regrets": (0.6, 0.02), "no_mathematics": (0.9, 0.1), "speaks_of_itself": (0.8, 0.05), "short": (0.8, 0.2)}),
    "copied_question": ("copied_question", {"text_inside": (0.95, 0.03), "final_inside": (0.7, 0.01), "nothing_new_anywhere": (0.95, 0.02), "no_new_number": (0.95, 0.1), "compresses_away": (0.9, 0.05)}),
    "other_language": ("other_language", {"function_words": (0.9, 0.01), "script": (0.95, 0.01), "most_steps": (0.9, 0.02), "no_shared_short_words": (0.9, 0.2), "diacritics": (0.8, 0.05)}),
    "truncated_step": ("truncated_answer", {"corpus_goes_on": (0.9, 0.02), "no_end_mark": (0.95, 0.2), "open_structure": (0.3, 0.005), "dangling_word": (0.3, 0.005), "stopped_by_length": (0.4, 0.1)}),
    "truncated_final": ("truncated_answer", {"open_structure": (0.7, 0.0005), "dangling_word": (0.4, 0.0005), "bare_command": (0.3, 0.0005), "stopped_by_length": (0.4, 0.1)}),
    "empty_answer": ("empty_answer", {"nothing_left": (0.7, 0.0005), "placeholder": (0.4, 0.0005), "hardly_a_letter": (0.8, 0.05), "no_content": (0.95, 0.1)}),
}
CLASSES = tuple(FUNCTIONS)
# Chosen by answer_calibration.calibrate on half of its labelled pairs, checked on the other half (see tests/llm).
CUTOFFS = {c: x["cutoff"] for c, x in CALIBRATED.items()}
ROUNDS = 100
SHARED_ROWS = 1024
PRIOR_SHARE = 0.002
FILTER_BITS = 1 << 26
BITS_PER_RUN = 16
FINISHED = 0.5
# By the kind of the last token: lengths of the runs, and the share where nothing was seen. A number, a closed formula or
# a single letter (i.e., d. h.) may stand before a mark anywhere, so it is judged with the words before it.
RUNS = {"word": ((1, 2, 3, 4), 0.1), "letter": ((2, 3, 4), 0.1), "sign": ((4, 6, 8), 0.1), "whole": ((3, 4), 0.6)}

# Function words by which the languages in Latin script are told apart.
STOP = {
    "en": "the of and to is are in that for with as by we be from so it each how what at on this an which not has into whose its does if then they when these was were all".split(),
    "de": "der die das und ist von zu den mit für auf wie viele noch dass eine ein einen hat sich im dem nach also man wir aus wenn oder des es er sie nicht wird werden daraus folgt sofort am gibt laut stammt wegen genau beträgt".split(),
    "fr": "le la les des une un est et en que pour dans sur du au il combien avec par cette encore on nous qui de d l ce se faut quelle quel possède vaut dans puis même plus".split(),
    "es": "el la los las una un que de en y se para por con hay según todavía es del al como cuántas cuántos qué aquí tiene entre más sus su no cuando pues deduce".split(),
}
_STOP = {w: [(k, 1 / len(ks)) for k in ks] for v in STOP.values() for w in v if (ks := [k for k, u in STOP.items() if w in u])}
_LATIN_HINT = {"ß": "de", "ä": "de", "ö": "de", "ü": "de", "ñ": "es", "¿": "es", "¡": "es", "í": "es", "ó": "es", "ú": "es", "ç": "fr", "è": "fr", "ê": "fr", "à": "fr", "œ": "fr", "ô": "fr", "û": "fr", "î": "fr"}

_label = re.compile(r"^\s*(?:>\s*|[-*•]\s+|(?:step|étape|schritt|paso|шаг)\s*\d+\s*[:.)]\s*|(?:步骤|第)\s*\d+\s*步?\s*[:：.]\s*|\(?\d{1,2}[.)](?=\s|$)\s*)", re.I)
_lead = re.compile(r"^[\s\"'“«]*(?:(?:the\s+)?(?:final\s+)?answer(?:\s+is)?\s*:|q(?:uestion)?\s*:|problem\s*:|we are told\s*:|we are asked\s*:)\s*", re.I)
_formula = re.compile(r"\$\$?[^$]*\$\$?|\\[a-zA-Z]+")
_quoted = re.compile(r"\([^()]*[\"“«][^\"”»]*[\"”»][^()]*\)|\"[^\"]{1,20}\"")
_letters = re.compile(r"[^\W\d_]+")
_ascii_letters = re.compile("[a-z]+")
_end = re.compile(r"[.!?。！？।؟॥…][\"'”’»」』)\]*]*\s*$|[\]}$]\s*$")
_real_end = re.compile(r"[.!?。！？।؟॥][\"'”’»」』)\]*]*\s*$")
_not_word = re.compile(r"[\W_]+")
# Numbers, single characters of scripts without spaces, words with their vowel signs, other signs.
_UNSPACED = "\u0e01-\u0e4e\u0e80-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff"
_token = re.compile(rf"\d+(?:[.,]\d+)*|[{_UNSPACED}]|(?:(?![{_UNSPACED}])[^\W\d_]|[\u0300-\u036f\u064b-\u065f\u0900-\u0963\u0970-\u0dff])+|\S")
_unspaced = re.compile(f"[{_UNSPACED}]")
_END_MARKS = frozenset(".!?。！？।؟॥")
_dangling = re.compile(r"(?:[+\-=*/^<>,:(\[{]|\\[a-zA-Z]+|\b(?:the|of|a|an|and|or|to|is|in|by|that|with|for|we|so|as|from|number|hence|now))\s*$", re.I)

_apology = re.compile(
    r"(?:^|[.!?:]\s|\n)\s*[\"“]?(?:(?:i['’]?m|i am)\s+(?:really\s+|very\s+)?(?:sorry|afraid)|sorry\s*[,:;]|unfortunately|regrettably|(?:my\s+)?apologies|i apologi[sz]e|thanks? (?:you )?for asking|to be clear|"
    r"leider|tut mir leid|entschuldigung|désolée?|malheureusement|je regrette|lo siento|lamento|lamentablemente|por desgracia|к сожалению|извините|простите|抱歉|对不起|很遗憾|申し訳|すみません|残念|ごめん|क्षमा|माफ़|खेद|ขออภัย|ขอโทษ|เสียใจ|عذر|آسف|أعتذر|نأسف|للأسف)",
    re.I,
)
_cannot = re.compile(
    r"\b(?:i|we)\s*(?:['’]m|am|are)?\s*(?:really\s+|simply\s+)?(?:can(?:not|['’]?t| not)|could not|will not|won['’]?t|would (?:prefer|rather) not|(?:am |are )?(?:unable|not able|not allowed|not permitted|not in a position|not willing|not comfortable)|must (?:decline|refuse|refrain|pass)|"
    r"(?:have|need|want) to (?:decline|pass|refuse|refrain)|have decided (?:not|against)|decline|refuse|prefer not|do(?: not|n['’]?t) (?:feel|think (?:i|it)|wish|want|provide|offer|answer|solve|help))\b(?![^.]{0,25}\b(?:divide|cancel|both|assume|conclude|exceed|be negative)\b)"
    r"|\bmy (?:instructions|guidelines|policy|rules|programming)\b|\b(?:something|request|question|task) (?:that )?i (?:can(?:not|['’]?t)|will not|won['’]?t|would rather not|must not|am not)|\bfalls? outside\b|\bbeyond what i\b|\bplease (?:take|ask|bring|consult|direct)\b[^.]*\b(?:teacher|tutor|instructor|expert|someone|instead)\b"
    r"|\bproviding (?:an|the|this) (?:answer|solution)\b[^.]*\b(?:not|in)\b|\bno (?:solution|answer) (?:will|can) be (?:offered|given|provided|supplied)\b|\bas an? (?:ai|assistant|language model)\b|\bnot (?:going to|something i)\b|\bask me (?:something|anything) else\b|\bgraded homework\b|\bpart of an exam\b",
    re.I,
)
_cannot_other = re.compile(
    r"\b(?:ich|wir)\b[^.]{0,40}\bnicht\b[^.]{0,40}\b(?:helfen|lösen|beantworten|beantworte|antworten|bearbeiten|weiterhelfen)|\b(?:darf|kann|möchte|werde|will)\b[^.]{0,40}\b(?:ich|leider)\b[^.]{0,40}\bnicht\b|\blehne\b[^.]{0,40}\bab\b|"
    r"\bje\b[^.]{0,40}\b(?:ne (?:peux|puis|souhaite|veux|suis)|préfère ne pas|refuse|dois (?:refuser|décliner))|\b(?:no puedo|no debo|no quiero|prefiero no|me niego|no me es posible|debo (?:rechazar|declinar)|no estoy en condiciones)\b|"
    r"не могу|не буду|не стану|вынужден\w* отказ|отказываюсь|отказаться от|не вправе|воздержусь|无法(?:回答|解答|作答|提供|协助|帮)|不便(?:作答|回答|解答)|不能(?:回答|解答|作答|提供|协助|帮)|拒绝(?:回答|作答|解答)?|恕(?:我|难|不)|不予作答|"
    r"お答え(?:でき|する?こと|しかね)|お断り|できかねます|お手伝いできません|回答(?:でき|を控え|を差し控え|いたしかね)|解くことはできません|お応えできません|नहीं (?:कर|दे|बता|सुलझा|हल)|मदद नहीं|उत्तर नहीं|हल नहीं|असमर्थ|मना कर|अनुमति नहीं|जवाब नहीं|"
    r"ไม่สามารถ|ไม่ขอ|ไม่อาจ|ขอปฏิเสธ|ขอไม่|ปฏิเสธ|ไม่สะดวก|ช่วยไม่ได้|لا (?:أستطيع|يمكنني|أقدر|أرغب|يسعني|أود)|لن (?:أ|ي)\w*|أرفض|أعتذر عن|غير قادر|أفضل (?:عدم|ألا)|لست قادر",
    re.I,
)
_not_unique = re.compile(r"\b(?:determined|not unique|no unique|does not exist|contradict|missing|underdetermined|insufficient)\b", re.I)

_tags = re.compile(r"<[^<>]*>")
_wrappers = re.compile(r"\\(?:boxed|fbox|text|textbf|mathrm|mathbf|mathit|left|right|quad|displaystyle|,|;|!|\(|\)|\[|\])")
_answer_words = re.compile(r"final[_ ]?answer|answer|\bans\b|solution|respuesta|réponse|antwort|ответ|答案|答え|the .{0,3}is\s*$", re.I)
# Words that stand for a missing answer.
PLACEHOLDERS = frozenset("na nan none null nil tbd tba todo pending blank empty undefined unknown placeholder missing xxx xx insert here your".split())


class _Scripts(dict):
    """A translate table from characters to one letter for their script; other characters go."""

    def __missing__(self, code: int):
        c = chr(code)
        if not c.isalpha() and not "\u0e00" <= c <= "\u0e7f" and not "\u0900" <= c <= "\u097f":
            k = None
        elif c < "\u0250":
            k = "l"
        else:
            k = next((k for k, (a, b) in _RANGES.items() if a <= c <= b), "o")
        self[code] = k
        return k


_RANGES = {"r": ("\u0400", "\u04ff"), "a": ("\u0600", "\u06ff"), "h": ("\u0900", "\u097f"), "t": ("\u0e00", "\u0e7f"), "j": ("\u3040", "\u30ff"), "z": ("\u4e00", "\u9fff")}
_SCRIPT_NAMES = {"l": "latin", "r": "ru", "a": "ar", "h": "hi", "t": "th", "j": "ja", "z": "zh", "o": "other"}
_scripts = _Scripts()


class Profile:
    """What a text shows of its language: letters by script, function words and special letters by language."""

    __slots__ = ("scripts", "points", "hints", "words")

    def __init__(self, text: str = ""):
        self.scripts: dict[str, int] = {}
        self.points: dict[str, float] = {}
        self.hints: dict[str, int] = {}
        self.words: list[str] = []
        if not text:
            return
        if "$" in text or "\\" in text:
            text = _formula.sub(" ", text)
        if text.isascii():
            self.words = words = _ascii_letters.findall(text.lower())
            if words:
                self.scripts = {"l": len("".join(words))}
        else:
            self.words = words = _letters.findall(text.lower())
            letters = text.translate(_scripts)
            self.scripts = {k: n * (3 if k in "jz" else 1) for k in _SCRIPT_NAMES if (n := letters.count(k))}
            for c in set(text):
                if c in _LATIN_HINT:
                    self.hints[_LATIN_HINT[c]] = self.hints.get(_LATIN_HINT[c], 0) + text.count(c)
        points = self.points
        for w in filter(_STOP.__contains__, words):
            for k, v in _STOP[w]:
                points[k] = points.get(k, 0.0) + v

    def add(self, other: "Profile") -> None:
        for mine, its in ((self.scripts, other.scripts), (self.points, other.points), (self.hints, other.hints)):
            for k, v in its.items():
                mine[k] = mine.get(k, 0) + v
        self.words += other.words

    def short(self) -> set[str]:
        return {w for w in set(self.words) if len(w) <= 4}

    def script(self) -> str | None:
        """The script of most letters; Japanese if there is some kana."""
        if not self.scripts:
            return None
        counts = self.scripts
        if counts.get("j", 0) * 8 > counts.get("z", 0):
            counts = counts | {"j": counts.get("j", 0) + counts.get("z", 0), "z": 0}
        return _SCRIPT_NAMES[max(counts, key=counts.get)]

    def language(self) -> str | None:
        """A language code by script and function words, or None if too little speaks for any."""
        kind = self.script()
        if kind != "latin":
            return kind
        first, second, best = 0.0, 0.0, None
        for k in STOP:
            v = self.points.get(k, 0.0) + 0.7 * self.hints.get(k, 0)
            if v > first:
                first, second, best = v, first, k
            elif v > second:
                second = v
        return best if first >= 1 and first > 1.3 * second else None


def script(text: str) -> str | None:
    return Profile(text).script()


def language(text: str) -> str | None:
    return Profile(text).language()


_ascii_signs = {k: None for k in range(128) if not chr(k).isalnum()}


def _plain(text: str) -> str:
    """Letters and digits in lower case."""
    return text.lower().translate(_ascii_signs) if text.isascii() else _not_word.sub("", unicodedata.normalize("NFKC", text).lower())


class _Unseen(dict):
    """A translate table that removes control and format characters other than white space."""

    def __missing__(self, code: int):
        c = chr(code)
        self[code] = None if unicodedata.category(c) in ("Cf", "Cc") and not c.isspace() else code
        return self[code]


_unseen = _Unseen()


def _strip(text: str | None) -> str:
    if not text:
        return ""
    return text.strip() if text.isascii() else text.translate(_unseen).strip()


_math_sign = re.compile(r"\\(?!boxed|fbox|text|left|right|math|quad|displaystyle)[a-zA-Z]+|[∅∞π√]")
_closed_sign = re.compile(r"\\(?:emptyset|infty|pi|varnothing|alpha|beta|gamma|theta|phi|lambda|mu|sigma|omega|circ|%)\s*[$})\]]*$")
_bare_command = re.compile(r"\\[a-zA-Z]+$")
_mathematics = re.compile(r"[\d\\$=]")
_digits = re.compile(r"\d+")
_beyond_latin = re.compile("[\u0370-\u1fff\u2c00-\ud7ff\uf900-\uffef]")
# Words and signs by which one speaks of oneself in the singular.
SELF_WORDS = frozenset("i my me myself ich mir mich mein meine meiner meinen je j yo mi mis puedo debo lamento prefiero siento я мне меня мой моей أنا أستطيع أعتذر أرفض أفضل أود أقدر أرغب لست يمكنني لدي آسف मैं मुझे मेरी मेरे".split())
SELF_SIGNS = ("我", "私", "お答え", "いたし", "申し訳", "मैं", "मुझे", "मेर", "ผม", "ฉัน", "ขอ")
# Words without one of which none of the refusal patterns can match in Latin script.
CANNOT_WORDS = frozenset(
    "can cannot not could won would prefer unable decline refuse refrain pass instructions guidelines policy rules programming fall falls beyond please providing no ai assistant language something anything graded homework exam "
    "nicht lehne ne refuse préfère décliner refuser puedo debo quiero prefiero niego posible condiciones".split()
)
SORRY_WORDS = frozenset("sorry afraid unfortunately regrettably apologies apologize apologise thanks thank clear leider tut entschuldigung désolé désolée malheureusement regrette siento lamento lamentablemente desgracia".split())


def tokens(step: str) -> list[str]:
    """The tokens of a step behind a sign for its start, numbers as one sign."""
    return ["\n", *("9" if x[0].isdigit() else x for x in _token.findall(_label.sub("", step.strip().lower())))]


def _run_keys(h: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """A key for the run of k tokens that ends at each place; 0 where a step has no such run."""
    out = np.zeros(len(h), np.uint64)
    out[k - 1 :] = tx.mix(tx.run_hashes(h, k) + np.uint64(k))
    out[np.arange(len(h)) - np.repeat(offsets[:-1], np.diff(offsets)) < k - 1] = 0
    return out


def ending_keys(step: str) -> tuple[list[int], float]:
    """Keys of the runs that end a step, shortest first, and the share of finished ones if none was seen."""
    words = tokens(step)
    last = words[-1]
    lengths, share = RUNS["whole" if last[0].isdigit() or last in ")]}$%°" else "sign" if _unspaced.match(last) else "letter" if len(last) == 1 else "word"]
    lengths = [k for k in lengths if k <= len(words)] or [len(words)]
    h = tx.hash_strings(words)
    return [int(_run_keys(h[-k:], np.array([0, k]), k)[-1:].view(np.int64)[0]) for k in lengths], share


def _vote(yes: bool, no: bool) -> str:
    return "+" if yes else "-" if no else "0"


def _behind(pattern: re.Pattern, text: str) -> str:
    """The text without what the pattern matches at its start."""
    m = pattern.match(text)
    return text[m.end() :] if m else text


GRAM = 5


def _shares_inside(rows: list[tuple[list[str], str]]) -> list[list[tuple[int, int]]]:
    """For each row's pieces how many of their runs of GRAM characters stand in the row's other text, and how many there are.

    All rows at a time: runs are hashed with their row's number and met by one sort. A piece shorter than a run counts as one.
    """
    texts = [t for pieces, p in rows for t in (p, *pieces)]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    row = np.repeat(np.arange(len(rows)), [1 + len(pieces) for pieces, _ in rows])
    n = np.maximum(size - GRAM + 1, 0)
    which = np.repeat(np.arange(len(texts)), n)
    at = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(end - size, n)
    key = tx.run_hashes(code, GRAM)[at] >> np.uint64(22) | row[which].astype(np.uint64) << np.uint64(42)
    first = np.zeros(len(texts), bool)
    first[np.cumsum([0, *(1 + len(pieces) for pieces, _ in rows)])[:-1]] = True
    asked = first[which]
    base, own, whose = np.sort(key[asked]), key[~asked], which[~asked]
    order = np.argsort(own)  # sorted queries are met far faster
    own = own[order]
    hit = base[np.minimum(np.searchsorted(base, own), len(base) - 1)] == own if len(base) else np.zeros(len(own), bool)
    hits = np.bincount(whose[order[hit]], minlength=len(texts)).tolist()
    out, k = [], 0
    for pieces, p in rows:
        out.append([(hits[k + 1 + i], len(x) - GRAM + 1) if len(x) >= GRAM else (int(x in p), 1) for i, x in enumerate(pieces)])
        k += 1 + len(pieces)
    return out


def _open_structure(text: str) -> bool:
    return text.count("$") % 2 == 1 or text.count("{") > text.count("}") or text.count("(") > text.count(")") or text.count("[") > text.count("]")


@dataclass
class _Pair:
    """A pair's parts as the labelling functions read them."""

    problem: str
    raw: list[str]
    prose: list[str]
    final: str
    finish: str
    bare: str
    left: str
    math_sign: bool
    said: list[str]
    p: str
    pieces: list[str]


def _read(problem: str | None, steps: list[str | None] | None, final: str | None, finish: str | None) -> _Pair:
    problem, final = _strip(problem), _strip(final)
    raw = [x for s in steps or [] if (x := _strip(s))]
    prose = [b for s in raw if (b := _behind(_lead, _behind(_label, s)))]
    bare = final if final.isalnum() else _wrappers.sub("", _tags.sub("", final))
    left = _plain(_answer_words.sub("", bare))
    math_sign = ("\\" in final or not final.isascii()) and _math_sign.search(final) is not None
    said = [*prose, *([final] if left or math_sign else [])]
    return _Pair(problem, raw, prose, final, (finish or "").strip().lower(), bare, left, math_sign, said, _plain(problem), [x for y in said if (x := _plain(_behind(_lead, y)))])


def votes(problem: str | None, steps: list[str | None] | None, final: str | None, finish: str | None) -> tuple[list[str], str, str]:
    """The votes of _votes for one pair."""
    pair = _read(problem, steps, final, finish)
    return _votes(pair, _shares_inside([(pair.pieces, pair.p)])[0])


def _votes(pair: _Pair, inside: list[tuple[int, int]]) -> tuple[list[str], str, str]:
    """The labelling functions' votes for each class, with an open last step taken as one the corpus goes on after; the votes for
    truncated_step with that step taken as finished; and the last step. inside: how much of each piece stands in the problem."""
    problem, raw, prose, final, left, math_sign, said = pair.problem, pair.raw, pair.prose, pair.final, pair.left, pair.math_sign, pair.said
    end = _plain(_behind(_lead, final))
    if end == "wrongproblem":
        none = ["-" * len(fs) for _, fs in FUNCTIONS.values()]
        return none, none[3], ""
    stopped = _vote(pair.finish in ("length", "max_tokens"), pair.finish == "stop")

    # empty_answer
    blank = not left and not math_sign
    word = bool(left) and left in PLACEHOLDERS and len(final) < 40
    digits = any(map(str.isdigit, final))
    told = bool(left) and (left in _plain("".join(prose)) if not digits else True)
    empty = _vote(blank, True) + _vote(word, True) + _vote(not digits and not math_sign and len(_plain(pair.bare)) <= 3, True) + _vote(not digits and not math_sign and not told, digits or math_sign or told)

    # refusal
    ask, tell = Profile(problem), Profile()
    each = [Profile(_quoted.sub(" ", b) if '"' in b or "(" in b else b) for b in prose]
    for x in each:
        tell.add(x)
    whole = "\n".join(said)
    words = set(tell.words)
    if len(said) > len(prose):
        words.update(_letters.findall(final.lower()))
    foreign_script = not whole.isascii() and _beyond_latin.search(whole) is not None
    cannot = (foreign_script or not words.isdisjoint(CANNOT_WORDS)) and any((_cannot.search(x) or _cannot_other.search(x)) and not (_not_unique.search(x) and not _apology.search(x)) for x in said[-2:])
    refusal = (
        _vote(cannot, True)
        + _vote((foreign_script or not words.isdisjoint(SORRY_WORDS)) and _apology.search(whole) is not None, True)
        + _vote(bool(whole) and not _mathematics.search(whole), bool(whole))
        + _vote(not words.isdisjoint(SELF_WORDS) or foreign_script and any(k in whole for k in SELF_SIGNS), bool(whole))
        + _vote(bool(whole) and len(whole) < 0.6 * len(problem) and len(said) <= 3, bool(whole))
    )

    # copied_question
    p, pieces = pair.p, pair.pieces
    hits, runs = sum(h for h, _ in inside), sum(n for _, n in inside)
    enough = sum(map(len, pieces)) >= 12 and len(p) >= 12
    share = hits / runs if runs else 0.0
    final_in = inside[-1][0] / inside[-1][1] if inside and len(end) >= 12 and (left or math_sign) else 0.0
    least = min((h / n for h, n in inside), default=0.0)
    if not enough:
        copied = "00000"
    else:
        new = set(_digits.findall(whole)) - set(_digits.findall(problem))
        fits = 1.0
        if share > 0.3:
            a, b = problem.lower().encode(), whole.lower().encode()
            fits = (len(zlib.compress(a + b"\n" + b, 6)) - len(zlib.compress(a, 6))) / len(b)
        copied = (
            _vote(share >= 0.75, share < 0.6)
            + _vote(final_in >= 0.7, bool(end) and final_in < 0.6)
            + _vote(least >= 0.5, True)
            + _vote(not new, True)
            + _vote(fits < 0.15, fits > 0.25)
        )

    # other_language
    one, two, sp, ss = ask.language(), tell.language(), ask.script(), tell.script()
    per = [k for x in each if (k := x.language())]
    other = sum(k != one for k in per) / len(per) if per and one else None
    short, short2 = ask.short(), tell.short()
    common = len(short & short2)
    hint, hint2 = (max(x.hints, key=x.hints.get) if x.hints else None for x in (ask, tell))
    both = bool(sp and ss)
    foreign = (
        _vote(bool(one and two and one != two), bool(one and two and one == two))
        + _vote(both and sp != ss, both and sp == ss and sp != "latin")
        + _vote(other is not None and other > 0.6, other is not None and other < 0.4)
        + _vote(both and len(short2) >= 4 and len(short) >= 4 and not common, common >= 2)
        + _vote(bool(hint and hint2 and hint != hint2), bool(hint and hint2 and hint == hint2))
    )

    # truncated_step
    last = raw[-1] if raw else ""
    core = _behind(_label, last).strip()
    closed = bool(_real_end.search(core))
    unfinished = bool(last) and not closed
    open_ = bool(core) and not closed and _open_structure(core)
    dangling = unfinished and bool(core) and bool(_dangling.search(core, core.rfind(" ") + 1))
    rest = _vote(unfinished, bool(last)) + _vote(open_, bool(core)) + _vote(dangling, bool(core)) + stopped
    step = _vote(unfinished, True) + rest

    # truncated_final
    if blank or word:
        cut = "0000"
    else:
        sign = _closed_sign.search(final) is not None
        cut = _vote(_open_structure(final), True) + _vote(not sign and bool(_dangling.search(final)), True) + _vote(not sign and final[-1:].isalpha() and bool(_bare_command.search(final)), True) + stopped
    return [refusal, copied, foreign, step, cut, empty], ("+" if not core and last else "-") + rest, last if core else ""


_ROW = "answer_id long, pattern string, if_finished string, keys array<long>, unseen double"


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, *fields = (b.column(i).to_pylist() for i in range(b.num_columns))
        got, pairs = [], [_read(*row) for row in zip(*fields)]
        shares = [x for k in range(0, len(pairs), SHARED_ROWS) for x in _shares_inside([(q.pieces, q.p) for q in pairs[k : k + SHARED_ROWS]])]
        for pair, inside in zip(pairs, shares):
            out, finished, last = _votes(pair, inside)
            asks = bool(last) and finished != out[3]
            keys, unseen = ending_keys(last) if asks else (None, None)
            got.append(("|".join(out), "|".join([*out[:3], finished, *out[4:]]) if asks else None, keys, unseen))
        pattern, other, keys, unseen = zip(*got) if got else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(pattern, pa.string()), pa.array(other, pa.string()), pa.array(keys, pa.list_(pa.int64())), pa.array(unseen, pa.float64())], names=["answer_id", "pattern", "if_finished", "keys", "unseen"]
        )


def _count_batches(bits: int, shared):
    """For each run that is asked for: occurrences that end something, and others. Open last steps' ends are left out."""
    lengths = sorted({k for ks, _ in RUNS.values() for k in ks} | {2})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.zeros(bits // 8, np.uint8)
        size = min(1 << 16, len(wanted))
        for k, blob in shared.value:
            wanted[k * size : (k + 1) * size] = np.frombuffer(zlib.decompress(blob), np.uint8)
        for b in batches:
            lists, inner = [], []
            for steps in b.column(0).to_pylist():
                raw = [x for s in steps or [] if (x := _strip(s))]
                lists += [tokens(x) for x in raw]
                inner += [True] * (len(raw) - 1) + [False] * bool(raw)
            if not lists:
                continue
            h, offsets = tx.hash_word_lists(lists)
            mark = np.isin(h, tx.hash_strings(sorted(_END_MARKS)))
            aside = np.isin(h, tx.hash_strings(["(", "（"]))  # a bracket does not tell whether the sentence goes on
            final = offsets[1:] - 1
            ends = np.append(mark[1:], False)
            ends[final] = inner
            counts = np.append(~aside[1:], True)
            counts[final] = inner
            keys, done = [], []
            for k in lengths:
                key = _run_keys(h, offsets, k).view(np.int64) if len(h) >= k else np.zeros(len(h), np.int64)
                at = np.flatnonzero(counts & (key != 0))
                at = at[near_dups._in_filter(wanted, key[at])]
                keys.append(key[at])
                done.append(ends[at])
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            ended = np.bincount(back, weights=np.concatenate(done), minlength=len(key)).astype(np.int64)
            total = np.bincount(back, minlength=len(key)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(ended), pa.array(total)], names=["key", "ended", "total"])

    return run


def _finished_endings(answers: DataFrame, voted: DataFrame) -> DataFrame:
    """asked: the longest run of each ending that is asked for and found to end something. voted: rows of _ROW."""
    spark = answers.sparkSession
    asked = runtime.materialize(voted.filter("keys is not null").groupBy(F.element_at("keys", -1).alias("asked")).agg(F.min("keys").alias("keys"), F.min("unseen").alias("unseen")), "endings")
    runs = asked.select(F.explode("keys").alias("key"))
    bits = 1 << 16
    while bits < min(FILTER_BITS, BITS_PER_RUN * runs.count()):
        bits *= 2
    filled = runs.coalesce(8).mapInArrow(near_dups._fill_filter(bits), "segment int, blob binary").repartition("segment").sortWithinPartitions("segment")
    shared = spark.sparkContext.broadcast([(r[0], bytes(r[1])) for r in filled.mapInArrow(near_dups._merge_filter, "segment int, blob binary").collect()])
    counted = answers.select("solution_steps").mapInArrow(_count_batches(bits, shared), "key long, ended long, total long").groupBy("key").agg(F.sum("ended").alias("ended"), F.sum("total").alias("total"))
    levels = asked.select("asked", "unseen", F.posexplode("keys").alias("level", "key")).join(counted, "key", "left").fillna(0, ["ended", "total"])
    seen = levels.groupBy("asked").agg(F.min("unseen").alias("unseen"), F.array_sort(F.collect_list(F.struct("level", "ended", "total"))).alias("levels"))
    share = F.aggregate("levels", F.col("unseen"), lambda s, x: (x["ended"] + s) / (x["total"] + F.lit(1.0)))  # at most four levels
    return seen.filter(share >= FINISHED).select("asked")


class LabelModel:
    """A two-class model of one latent class: vote probabilities of each function, and the class's share."""

    def __init__(self, rates: list[tuple[float, float]]):
        self.start = np.array([[[1 - r[y], r[y]] for r in rates] for y in (1, 0)])  # outside, inside: function, (-, +)
        self.table, self.prior = self.start.copy(), 0.03

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Of each vote pattern; an abstention says nothing."""
        votes_ = _codes(patterns)
        logs = [np.log(w) + sum(np.append(np.log(self.table[y, k]), 0.0)[votes_[:, k]] for k in range(self.start.shape[1])) for y, w in ((0, 1 - self.prior), (1, self.prior))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    def fit(self, patterns: list[str], counts: np.ndarray, rounds: int = ROUNDS) -> "LabelModel":
        """EM over the pattern counts. The start stays as a weak prior of PRIOR_SHARE of the rows, so classes cannot change places."""
        if not patterns:
            return self
        votes_, strength, post = _codes(patterns), max(1.0, PRIOR_SHARE * counts.sum()), None
        for _ in range(rounds):
            new = self.posterior(patterns)
            if post is not None and np.abs(new - post).max() < 1e-9:
                break
            post = new
            for y, w in ((0, counts * (1 - post)), (1, counts * post)):
                for k in range(votes_.shape[1]):
                    seen = np.bincount(votes_[:, k], weights=w, minlength=3)[:2] + strength * self.start[y, k]
                    self.table[y, k] = seen / seen.sum()
            self.prior = float(np.clip((counts @ post + 1) / (counts.sum() + 20), 1e-4, 0.5))
        return self


def _codes(patterns: list[str]) -> np.ndarray:
    return np.array([["-+0".index(c) for c in p] for p in patterns])


def fit_all(table: list[tuple[str, str, int]]) -> dict[str, LabelModel]:
    """A model for each class from its pattern counts: rows of class, pattern, count."""
    models = {}
    for c, (_, functions) in FUNCTIONS.items():
        own = sorted((p, n) for k, p, n in table if k == c)
        models[c] = LabelModel(list(functions.values())).fit([p for p, _ in own], np.array([float(n) for _, n in own]))
    return models


def voted_rows(answers: DataFrame) -> DataFrame:
    """answer_id, votes array<string> by CLASSES, of each row once, with the corpus' word on open last steps."""
    runtime.ship_package(answers.sparkSession)
    rows = answers.select("answer_id", "problem", "solution_steps", "final_answer", "answer_finish_reason").filter("answer_id is not null")
    first = runtime.materialize(rows.mapInArrow(_vote_batches, _ROW), "first-votes")
    finished = _finished_endings(answers, first).withColumn("finished", F.lit(True))
    judged = first.filter("keys is not null").withColumn("asked", F.element_at("keys", -1)).join(finished, "asked", "left")
    judged = judged.select("answer_id", F.when(F.col("finished"), F.col("if_finished")).otherwise(F.col("pattern")).alias("pattern"))
    both = first.filter("keys is null").select("answer_id", "pattern").unionByName(judged)
    out = runtime.materialize(both.groupBy("answer_id").agg(F.min("pattern").alias("pattern")).select("answer_id", F.split("pattern", "[|]").alias("votes")), "votes")
    runtime.drop_materialized(first)
    return out


def models_of(voted: DataFrame) -> tuple[dict[str, LabelModel], list[tuple[str, str, int]]]:
    """The fitted models and the pattern counts they were fitted to: at most three to the number of functions for each class."""
    names = F.array(*(F.lit(c) for c in CLASSES))
    pairs = voted.select(F.explode(F.arrays_zip(names.alias("class"), F.col("votes").alias("pattern"))).alias("x")).select("x.class", "x.pattern")
    table = [(r[0], r[1], r[2]) for r in pairs.groupBy("class", "pattern").agg(F.count("*").alias("n")).collect()]
    return fit_all(table), table


def labels(answers: DataFrame, cutoffs: dict[str, float] | None = None) -> DataFrame:
    """answer_id, class, defect, votes, posterior, rank: every latent class of a row that passes its cutoff (rank by DEFECTS' order).

    answers: answer_id bigint, problem string, solution_steps array<string>, final_answer string,
    answer_finish_reason string.
    """
    cutoffs = CUTOFFS | (cutoffs or {})
    spark = answers.sparkSession
    voted = voted_rows(answers)
    models, table = models_of(voted)
    kept = []
    for c, (defect, _) in FUNCTIONS.items():
        own = [p for k, p, _ in table if k == c]
        if own:
            kept += [(CLASSES.index(c), c, p, defect, float(x), DEFECTS.index(defect)) for p, x in zip(own, models[c].posterior(own)) if x > cutoffs[c]]
    passing = spark.createDataFrame(kept, "k int, class string, pattern string, defect string, posterior double, rank int")
    rows = voted.select("answer_id", F.posexplode("votes").alias("k", "pattern"))
    return rows.join(F.broadcast(passing), ["k", "pattern"]).select("answer_id", "class", "defect", F.col("pattern").alias("votes"), "posterior", "rank")


def defects(answers: DataFrame, cutoffs: dict[str, float] | None = None) -> DataFrame:
    """answer_id, defect, posterior, rank: every defect of a row, with the highest posterior of its classes."""
    return labels(answers, cutoffs).groupBy("answer_id", "defect", "rank").agg(F.max("posterior").alias("posterior")).select("answer_id", "defect", "posterior", "rank")


def p3_found(spark, sf_dir: str) -> DataFrame:
    """The first fitting defect of each defective row."""
    found = defects(runtime.table(spark, sf_dir, "answered_rows"))
    first = found.groupBy("answer_id").agg(F.min(F.struct("rank", "defect")).alias("first"))
    return first.select("answer_id", F.col("first.defect").alias("defect"))


def p3_labels(spark, sf_dir: str) -> DataFrame:
    """Every label of every row with its votes and posterior, also those that p3_found passes over for an earlier one."""
    return labels(runtime.table(spark, sf_dir, "answered_rows")).select("answer_id", "defect", "class", "votes", "posterior")


def p3_manifest(spark, sf_dir: str) -> DataFrame:
    """What each file's manifest claims as failed against the rows found defective in it."""
    answers = runtime.table(spark, sf_dir, "answered_rows")
    found = defects(answers).select("answer_id").distinct().withColumn("bad", F.lit(1))
    rows = answers.select("answer_id", "source_file").distinct().join(found, "answer_id", "left")
    per = rows.groupBy(F.col("source_file").alias("file_name")).agg(F.count("*").alias("rows"), F.count("bad").alias("defective"))
    claimed = runtime.table(spark, sf_dir, "manifest").select("file_name", "total_rows", F.try_element_at("verdict_counts", F.lit("fail")).alias("claimed_fail"))
    return claimed.join(per, "file_name", "left").select("file_name", "total_rows", "claimed_fail", F.coalesce("rows", F.lit(0)).cast("long").alias("rows"), F.coalesce("defective", F.lit(0)).cast("long").alias("defective"))
