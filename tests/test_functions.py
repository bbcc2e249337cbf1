import pytest
from pyspark.sql import functions as F

from skeinworks.functions import ladder, validate
from skeinworks.functions import text as T


def value(spark, f, x, kind="string"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "f,x,want",
    [
        (T.normalize_text, " A  *B*_c ", "a bc"),
        (T.normalize_text, "a * b", "a  b"),
        (T.normalize_text, None, ""),
        (T.normalize_text, "x  y\t", "x y"),
        (T.boxed_answer, r"\boxed{\frac{1}{2}}", ""),
        (T.boxed_answer, r"\boxed{3} \boxed{ 4 }", "4"),
        (T.level_to_y, "Level 5", 1.0),
        (T.level_to_y, "?", 0.5),
        (lambda c: T.level_to_y(c, None), "?", None),
        (T.level_number, "Level 12", 12),
        (T.level_number, "", 0),
        (T.level_to_difficulty, "Level 2", "easy"),
        (T.level_to_difficulty, None, "medium"),
        (T.level_to_difficulty, "Level 4", "hard"),
        (T.subject_code, "see 11A05 here", "11A05"),
        (T.subject_code, "11a05", ""),
        (T.tokens, "The 2-nd x^2", ["the", "2", "nd", "x", "2"]),
        (T.seed_tokens, r"\frac{1}{22} the", [r"\frac", "22"]),
        (T.phrases, "A b | c! |  | a  B", ["a b", "c"]),
        (lambda c: T.short(c, 6), "abcdefgh", "abc..."),
        (lambda c: T.short(c, 6), " abcdef ", "abcdef"),
        (T.relation_count, r"x \le 3 = y < z", 3),
        (T.body_skeleton, "Let x = 3. Find y.", "let v = N."),
        (T.strip_step_label, "Step 2: add", "add"),
        (T.strip_step_label, "步骤3：加", "加"),
        (T.declared_symbols, "for real numbers x, y; let a, b be integer", ["x", "y", "a", "b"]),
        (T.declared_symbols, "let x be real", []),
        (T.assigned_symbols, "a = 3, b= x, a = 4", ["a", "b"]),
        (T.to_bool, "Yes", True),
        (T.to_bool, "maybe", False),
        (T.tagged_question, "a <q> body\n</Q> b", "body"),
        (T.tagged_question, " plain ", "plain"),
    ],
)
def test_text(spark, f, x, want):
    assert value(spark, f, x) == want


def test_render_and_match(spark):
    assert value(spark, T.render_steps, ["a", None], "array<string>") == "1. a\n2. "
    row = spark.createDataFrame([("1.0", " 1", "x", "X ")], "a string, b string, c string, d string")
    assert tuple(row.select(T.answers_match(F.col("a"), F.col("b")), T.answers_match(F.col("c"), F.col("d")), T.answers_match(F.col("a"), F.col("c"))).first()) == (True, True, False)


def test_difficulty_and_widths(spark):
    row = spark.createDataFrame([(0.5, [0.8, 0.6], 1, 3)], "n double, c array<double>, s int, m int")
    got = row.select(T.chain_difficulty(F.col("n"), F.col("c"), F.col("s"), F.col("m"))).first()[0]
    assert abs(got - (0.55 * 0.5 + 0.15 * 0.5 + 0.15 * 0.3 + 0.15 * 0.5)) < 1e-9
    assert value(spark, lambda c: T.scale_widths(c, F.lit(0.0), F.lit(0.0), 1, 3), 5.0, "double") == 2.0


def test_jaccard_of_empty_sets(spark):
    row = spark.createDataFrame([([], []), (["a"], ["a", "b"])], "a array<string>, b array<string>")
    assert [r[0] for r in row.select(T.jaccard(F.col("a"), F.col("b"))).collect()] == [0.0, 0.5]


@pytest.mark.parametrize("text,want", [("hi", "too_short"), ("What is x? What is y?", "multi_task"), ("Find x and then compute y", "multi_task"), ("Find the sum of certain steps", "placeholder"), ("Find x; compute y", "multi_task"), ("求出 x 并且计算 y 的值是多少", "multi_task"), ("Find the value of x", None), (None, "too_short")])
def test_surface(spark, text, want):
    assert value(spark, validate.surface_error, text) == want


@pytest.mark.parametrize(
    "raw,mode,got",
    [
        ('{"a": 1}', "direct", {"a": 1}),
        ('<think>x {"b": 2}</think>{"a": 1}', "direct", {"a": 1}),
        ('text ```json\n{"a": 1}\n``` more', "fenced", {"a": 1}),
        ('one {"a": 1} two {"a": "}"} three {bad}', "blob", {"a": "}"}),
        ('{"problem": "x\\ny \\nu", "level": "L', "fields", {"problem": "x\\ny \\nu"}),
        ("nothing", "none", {}),
        ("", "empty", {}),
        (None, "empty", {}),
    ],
)
def test_ladder(raw, mode, got):
    assert ladder.ladder(raw) == (mode, got)


def test_decode_escaped():
    assert ladder.decode_escaped(r"a\n1 \nu A \"q\" \\") == 'a\n1 \\nu A "q" \\'
    assert ladder.decode_escaped(r"\n1") == "1"


def test_ladder_column(spark):
    df = spark.createDataFrame([('{"problem": "p", "level": 3}',), (None,)], "x string")
    got = [r.r.asDict() for r in df.select(ladder.parse_ladder("x").alias("r")).collect()]
    assert got[0]["mode"] == "direct" and got[0]["level"] == "3" and got[1] == dict.fromkeys(("problem", "level", "type", "solution")) | {"mode": "empty"}
