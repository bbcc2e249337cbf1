import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skeinworks.llm import sentences as S
from skeinworks.llm.sentences import Weights, sentences, split_sentences

CASES = [
    ("Dr. Smith came at 6 a.m. sharp. He left.", ["Dr. Smith came at 6 a.m. sharp.", "He left."]),
    ("See Fig. 3 and p. 12 (cf. Sec. 2.1). Then J. K. Rowe spoke, i.e. she sang.", ["See Fig. 3 and p. 12 (cf. Sec. 2.1).", "Then J. K. Rowe spoke, i.e. she sang."]),
    ('"Stop at 3!" shouted Ann, and left. "Why?"', ['"Stop at 3!" shouted Ann, and left.', '"Why?"']),
    ('Bob wrote: "It is finite." The end.', ['Bob wrote: "It is finite."', "The end."]),
    ("It is 3.5 wide.The next follows. version 2.4 fails... or so.", ["It is 3.5 wide.", "The next follows.", "version 2.4 fails... or so."]),
    ("They list nets, rods, etc. in rows. They list rods, etc. Then more.", ["They list nets, rods, etc. in rows.", "They list rods, etc.", "Then more."]),
    ("Er kam am 4. Mai in den 5. Kasten. Es gibt Räder usw. in großer Zahl, d. h. viele.", ["Er kam am 4. Mai in den 5. Kasten.", "Es gibt Räder usw. in großer Zahl, d. h. viele."]),
    ("Anna fragte: „Wie viele bleiben übrig?“ und schrieb. Gut!", ["Anna fragte: „Wie viele bleiben übrig?“ und schrieb.", "Gut!"]),
    ("Il dit : « Combien reste-t-il ? » puis nota 8. Au n° 7 vit M. Roux.", ["Il dit : « Combien reste-t-il ? » puis nota 8.", "Au n° 7 vit M. Roux."]),
    ("¿Cuántas hay? ¡Qué bien! Según el Sr. Paz, hay 2 (véase la fig. 3).", ["¿Cuántas hay?", "¡Qué bien!", "Según el Sr. Paz, hay 2 (véase la fig. 3)."]),
    ("«Сколько осталось?» — спросил он. По словам А. Б. Иванова, т. е. автора, хватит.", ["«Сколько осталось?» — спросил он.", "По словам А. Б. Иванова, т. е. автора, хватит."]),
    ("他最后写道：“答案是7。”老师说“先数铃铛，再数车轮”。够吗？", ["他最后写道：“答案是7。”", "老师说“先数铃铛，再数车轮”。", "够吗？"]),
    ("先生は「数えなさい。」と言った。長さは3.5です。", ["先生は「数えなさい。」と言った。", "長さは3.5です。"]),
    ('"कितने बचे?" यह पूछकर गुरु ने 7 लिखा। डॉ. साहब आए।', ['"कितने बचे?" यह पूछकर गुरु ने 7 लिखा।', "डॉ. साहब आए।"]),
    ("قال د. نوفان إن العدد 3.5 كغ. هل يكفي؟ نعم.", ["قال د. نوفان إن العدد 3.5 كغ.", "هل يكفي؟", "نعم."]),
    ("รวมกัน 813 ชิ้น ต้องใช้อีก", ["รวมกัน 813 ชิ้น", "ต้องใช้อีก"]),
    ("# A heading. With points\n\nText goes\non here\n\n$$x = 1.$$\n\n- One. Two.\n- Three", ["# A heading. With points", "Text goes\non here", "$$x = 1.$$", "- One. Two.", "- Three"]),
    ("Q: What is it? It is $x$. $y = 2$ is next.", ["Q: What is it?", "It is $x$.", "$y = 2$ is next."]),
    ("> quoted line. Next", ["> quoted line.", "Next"]),
]


@pytest.mark.parametrize("text,want", CASES)
def test_cases(text, want):
    assert [text[a:b] for a, b in sentences(text)] == want


@given(st.text(alphabet="Ab .!?\n\t\"'()“”«»。「」$#-*1x ก", max_size=120))
@settings(max_examples=300, deadline=None)
def test_only_white_space_lies_outside(text):
    at = 0
    for a, b in sentences(text):
        assert at <= a < b and not text[at:a].strip() and text[a:b] == text[a:b].strip()
        at = b
    assert not text[at:].strip()


def test_long_text_is_kept_whole():
    text = "A short one. " * 20_000 + "X" * 200_000
    got = sentences(text)
    assert len(got) == 20_001 and got[-1][1] == len(text)


@pytest.mark.parametrize("text", ["He said " + "so ... and " * 100 + "left.", "He sang " + '"So?" asked Ann or ' * 70 + "no."])
def test_any_number_of_refused_places(text):
    whole = text + " Then he went."
    assert [whole[a:b] for a, b in sentences(whole)] == [text, "Then he went."]


ABLATIONS = [
    ("closing", "Dr. Smith met J. K. Rowe on the 5th (cf. Sec. 2). He left.", ["Dr. Smith met J. K. Rowe on the 5th (cf. Sec. 2).", "He left."]),
    ("closing", "Er kam am 4. Mai. Gut so.", ["Er kam am 4. Mai.", "Gut so."]),
    ("opening", '"Stop at 3!" shouted Ann, and left. "Why?"', ['"Stop at 3!" shouted Ann, and left.', '"Why?"']),
    ("opening", '"कितने बचे?" यह पूछकर गुरु ने 7 लिखा। ठीक।', ['"कितने बचे?" यह पूछकर गुरु ने 7 लिखा।', "ठीक।"]),
    ("opening", "They list rods, etc. in rows. Then more.", ["They list rods, etc. in rows.", "Then more."]),
    ("balance", 'She wrote: "It is finite. Then we go. Nobody stays." as her note. The end.', ['She wrote: "It is finite. Then we go. Nobody stays." as her note.', "The end."]),
    ("balance", "Он сказал: «Это верно. Хватит споров» и ушёл. Всё.", ["Он сказал: «Это верно. Хватит споров» и ушёл.", "Всё."]),
    ("balance", "We know (this is new. It holds always) the rest. Good.", ["We know (this is new. It holds always) the rest.", "Good."]),
    ("length", "... And so he left. Fine.", ["... And so he left.", "Fine."]),
    ("length", "We add the next part to it, and " * 40 + "we see it. then " + "we add the last part to it, and " * 40 + "stop.", ["We add the next part to it, and " * 40 + "we see it.", "then " + "we add the last part to it, and " * 40 + "stop."]),
]


@pytest.mark.parametrize("term,text,want", ABLATIONS)
def test_each_term_decides(term, text, want):
    """With all four terms the spans are right; without the term named here they are not."""
    assert [text[a:b] for a, b in sentences(text)] == want
    assert [text[a:b] for a, b in sentences(text, Weights(**{term: 0.0}))] != want


def _best_by_hand(place, close, open_, state, w):
    """The best segmentation by trying every one (few places only)."""
    best = None
    inner = range(1, len(place) - 1)
    for mask in range(1 << len(inner)):
        cut = [0, *(k for n, k in enumerate(inner) if mask >> n & 1), len(place) - 1]
        total = sum(S.span_score(place, close, open_, state, i, j, w) for i, j in zip(cut, cut[1:]))
        if best is None or total > best + 1e-9:
            best = total
    return best


@given(st.lists(st.tuples(st.integers(1, 900), st.floats(-9, 5), st.floats(-9, 2), st.integers(0, 3)), min_size=2, max_size=9))
@settings(max_examples=150, deadline=None)
def test_programme_finds_the_best_segmentation(steps):
    place, close, open_, state = [0], [0.0], [0.0], [0]
    for d, c, o, b in steps:
        place.append(place[-1] + d)
        close.append(c)
        open_.append(o)
        state.append(b)
    cuts = S.best_cuts(place, close, open_, state, S.WEIGHTS)
    got = sum(S.span_score(place, close, open_, state, i, j, S.WEIGHTS) for i, j in zip(cuts, cuts[1:]))
    assert cuts[0] == 0 and cuts[-1] == len(place) - 1
    assert got == pytest.approx(_best_by_hand(place, close, open_, state, S.WEIGHTS))


def test_frame(spark):
    df = spark.createDataFrame([(1, "One. Two.", 5), (2, None, 5), (3, "", 5), (4, " \n ", 5), (1, "One. Two.", 5)], "doc_id long, text string, char_start int")
    assert sorted(tuple(r) for r in split_sentences(df).collect()) == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9)]
    assert split_sentences(df.limit(0)).count() == 0
