"""Text, HTML, JSON and code helpers: known answers, edge rows and brute force."""

import itertools
import random
from difflib import SequenceMatcher

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType

from starloom.functions import alike as A
from starloom.functions import code as CO
from starloom.functions import html as H
from starloom.functions import rows as R
from starloom.functions import scalars as S
from starloom.functions import text as T


@pytest.fixture
def apply(spark):
    def run(expression, *values, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r.y for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]

    return run


def test_normalize(apply):
    assert apply(T.normalize_answer, "The  Cat's an (old) A-team!", "anthem the", "") == ["cats old ateam", "anthem", ""]


def test_last_number(apply):
    got = apply(T.last_number, "about 3 items for $1,234.50.", "none", "-7", "1,23,456", ".5")
    assert got == [1234.5, None, -7.0, 23456.0, 5.0]


def test_final_answer(apply):
    got = apply(T.final_answer, "a \\boxed{1} b \\boxed{\\frac{2}{3}}", "First. Pi is 3. 14 ok! The last one", "", "x. ")
    assert got == ["\\frac{2}{3}", "The last one", "", "x"]


@pytest.mark.parametrize("a,b,equal", [("5", "5", True), ("50%", "0.5", True), ("50\\%", "0.5", True), ("1,000", "1000", True), ("1.0004", "1", True),
                                       ("1.1", "1", False), ("x", "y", False), ("x", "x", True)])
def test_math_equal(spark, a, b, equal):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(T.math_equal(F.col("a"), F.col("b"))).first()[0] is equal


def windows(text, size):
    if len(text) <= size:
        return [text]
    step, out, i = size - 20 if size > 20 else size, [], 0
    while i < len(text):
        out.append(text[i:i + size])
        if size + i > len(text):
            break
        i += step
    return out


@pytest.mark.parametrize("size", [7, 20, 21, 50])
def test_windows(apply, size):
    texts = ["x" * n for n in (1, 6, 7, 8, 14, 20, 21, 22, 40, 50, 80, 81, 110, 137)]
    assert apply(lambda c: T.char_windows(c, size), *texts) == [windows(t, size) for t in texts]


def test_exact_fit_has_a_tail_window(apply):
    assert [len(w) for w in apply(lambda c: T.char_windows(c, 50), "x" * 80)[0]] == [50, 50, 20]


def test_split_paragraph(apply):
    got = apply(T.split_paragraph, "......", ".......", "a.b.c", "a,b", "abc")
    assert got == [["...", "..."], ["....", "..."], ["a.b.", "c"], ["a,", "b"], ["ab", "c"]]
    assert apply(lambda c: T.split_paragraph(c, 3), "1.2.3.4.") == [["1.2.", "3.", "4."]]


def test_pack_lines(apply):
    text = "\n".join(" ".join(f"w{i}" for i in range(n)) for n in (30, 50, 120, 10, 400, 5))
    chunks = apply(lambda c: T.pack_lines(c, 200), text)[0]
    assert "".join(chunks) == text and all(len(c.split()) <= 100 for c in chunks) and len(chunks) > 3
    assert apply(lambda c: T.pack_lines(c, 200), "", None) == [[], None]


def test_first_fitting(apply):
    assert apply(lambda c: T.first_fitting(F.split(c, "\\|"), 3), "a b c|a b|a") == ["a b"]
    with pytest.raises(Exception, match="no candidate is below"):
        apply(lambda c: T.first_fitting(F.split(c, "\\|"), 1), "a b c|a b")


def test_unicode_escape(apply):
    assert apply(T.decode_unicode_escape, "a\\u00e9b", "Hello, World!", None) == ["aéb", "Hello, World!", None]


def test_sections(apply):
    assert apply(T.tagged_section, "x [CONTENT] a\nb [/CONTENT] [CONTENT]c[/CONTENT]", "none") == ["a\nb", None]
    got = apply(T.role_and_text, "[USER]: hello", "plain")
    assert [tuple(g) for g in got] == [("USER", "hello"), (None, "plain")]


def test_answer_map(apply):
    got = apply(S.answer_map, "@mean[1,234.5] @name[x: y] @mean[2]", "")
    assert got[0] == {"name": "x y", "mean": "2"} and got[1] == {}


@pytest.mark.parametrize("broken,fixed", [('[{"a": 1}', '{"a": 1}'), ('{"a": 1}]', '{"a": 1}'), ('{"a": 1]', '{"a": 1}'),
                                          ('{"a": "x#y", # why\n"b": 2 // end\n}', '{"a": "x#y",\n"b": 2\n}')])
def test_repair_json(apply, broken, fixed):
    assert apply(T.repair_json, broken) == [fixed]


def test_is_json(apply):
    assert apply(T.is_json, '{"a": [1]}', '{"a": 1}{', "1,2", "", '{"a": }') == [True, False, False, False, False]


def test_repair_sections(apply):
    fix = lambda c: T.repair_sections(c, ["[/CONTENT]"])
    got = apply(fix, '[CONTENT]\n{"a": 1}', '{"a": 1}', '[CONTENT] x [CONTENT]', 'pre [CONTENT]\n{"a": 1} tail', "[content] {}\n[/content]", None)
    assert got[0] == '[CONTENT]\n{"a": 1}\n[/CONTENT]'
    assert got[1] == '[CONTENT]\n{"a": 1}\n[/CONTENT]'
    assert got[2] == "[CONTENT] x [/CONTENT]"
    assert got[3] == '[CONTENT]\n{"a": 1}\n[/CONTENT]'
    assert got[4].endswith("[/CONTENT]") and got[5] is None
    both = lambda c: T.repair_sections(c, ["[CONTENT]", "[/CONTENT]", "Shared Knowledge"])
    got = apply(both, "[content] {}\n[/Content]", "[CONTENT] a [CONTENT] b", "x: shared knowledge [CONTENT][/CONTENT]", "")
    assert got == ["[CONTENT] {}\n[/CONTENT]", "[CONTENT] a [/CONTENT] b", "x: Shared Knowledge [CONTENT][/CONTENT]", "[CONTENT]\n"]


def test_pack_lines_is_greedy(apply):
    rng = random.Random(3)
    text = "\n".join(" ".join("w" for _ in range(rng.randrange(0, 60))) for _ in range(50))
    chunks = apply(lambda c: T.pack_lines(c, 160), text)[0]
    assert "".join(chunks) == text
    for this, following in zip(chunks, chunks[1:]):
        assert len(this.split()) <= 60 < len(this.split()) + len(following.splitlines()[0].split())


def test_rouge_and_bleu(spark):
    random.seed(5)

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    pairs = [([random.choice("abcd") for _ in range(random.randrange(0, 30))], [random.choice("abcd") for _ in range(random.randrange(0, 30))]) for _ in range(40)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    got = {r.i: r for r in df.select("i", T.rouge_l("a", "b").alias("r"), T.bleu("a", "b").alias("b")).collect()}
    for i, (a, b) in enumerate(pairs):
        common = lcs(a, b)
        assert abs(got[i].r - (2 * common / (len(a) + len(b)) if common else 0.0)) < 1e-12
    same = df.filter("size(a) > 4").select(T.bleu("a", "a").alias("b")).first().b
    assert same.bleu_avg == pytest.approx(1.0) and same.brevity_penalty == 1.0


PAGE = """<html><head><title> A &amp; B </title><style>x</style></head><body><script>var t="</p>";</script>
<a href="/one?q=1">one</a><a href="two.html"> two </a><a href="https://x.org/z">three</a><a href="#top">top</a><a href="mailto:a@b.c">mail</a><a>none</a>
<img src="i.png" class="c"><p class="k" id="p" style="s">text<br>more</p><video><p>hidden</p></video><!-- note --><footer>foot</footer></body></html>"""


def test_page_parts(spark):
    row = H.parsed_pages(spark.createDataFrame([(1, "http://h.com/d/p.html", PAGE)], "page_id long, url string, html string")).first()
    assert row.title == "A & B"
    assert row.links == ["http://h.com/one?q=1", "http://h.com/d/two.html", "https://x.org/z"]
    assert row.text == "onetwothreetopmailnonetextmorehidden"


def test_pages_without_title_or_text(spark):
    row = H.parsed_pages(spark.createDataFrame([(1, "u", ""), (2, "u", None)], "page_id long, url string, html string")).collect()
    assert [(r.title, r.links, r.text) for r in row] == [("", [], "")] * 2


def test_slim(apply):
    slim = apply(lambda c: H.slim_html(c), PAGE)[0]
    assert '<p class="k" id="p">' in slim and "img" not in slim and "hidden" not in slim and "note" not in slim and "href" not in slim
    assert 'href="/one?q=1"' in apply(lambda c: H.slim_html(c, True), PAGE)[0]


def test_invalid_pages(spark):
    df = spark.createDataFrame([("  Fail to load page x",), ("Access Denied",), ("fine",)], "text string")
    assert [r.text for r in H.valid_pages(df).collect()] == ["fine"]


def test_symbols(spark):
    source = "X = 1\ny: int = 2\na, b = 1, 2\nclass C(D):\n    z = 1\n    def m(self): pass\n    async def n(self): pass\ndef f(): pass\n"
    rows = CO.file_symbols(spark.createDataFrame([("a.py", source), ("b.py", "def (")], "file string, content string")).orderBy("file").collect()
    assert [(c.name, c.methods) for c in rows[0].classes] == [("C", ["m", "n"])]
    assert rows[0].functions == ["f"] and rows[0].globals == ["X", "y"] and rows[0].error is None and rows[1].error


def test_whole_years(spark):
    df = spark.sql("select date'2000-02-29' a, date'2023-02-28' b, date'2024-02-29' c")
    assert tuple(df.select(S.whole_years(F.col("a"), F.col("b")), S.whole_years(F.col("a"), F.col("c"))).first()) == (22, 24)


def test_whole_days_and_scores(spark):
    df = spark.sql("select timestamp'2024-01-03 11:59:00' n, timestamp'2024-01-01 12:00:00' t")
    assert df.select(S.whole_days(F.col("n"), F.col("t"))).first()[0] == 1
    assert [r[0] for r in spark.createDataFrame([(-1.0,), (3.0,)], "s double").select(S.normalised_score(F.col("s"))).collect()] == [0.0, 0.25]


def test_monday_week(spark):
    import datetime

    days = [datetime.date(2020, 12, 28) + datetime.timedelta(d) for d in range(0, 900, 3)]
    got = spark.createDataFrame([(d,) for d in days], "d date").select("d", S.monday_week(F.col("d")).alias("w")).collect()
    assert all(r.w == int(r.d.strftime("%W")) for r in got)


def test_alike_gives_the_answer_of_difflib():
    pick = random.Random(5)
    for _ in range(400):
        letters = pick.choice(["ab", "abcdefgh", "abcdefghijklmnopqrstuvwxyz .é漢字😀"])
        x = "".join(pick.choices(letters, k=pick.choice([0, 1, 5, 50, 250, 400])))
        y = list(x) if pick.random() < 0.6 else pick.choices(letters, k=pick.choice([0, 1, 5, 50, 250, 400]))
        for _ in range(pick.randrange(40) if y else 0):
            at = pick.randrange(len(y) + 1)
            y[at:at + pick.randrange(3)] = pick.choice(letters) * pick.randrange(3)
        y = "".join(y)
        matcher = SequenceMatcher(None, x, y)
        if x and y:
            assert A.Anchors(A._codes(x), A._codes(y)).longest(0, len(x), 0, len(y)) == tuple(matcher.find_longest_match())
        for threshold in (0.3, 0.5, 0.8, 0.95):
            assert A.alike(x, y, threshold) == (matcher.ratio() > threshold), (x, y, threshold)


def test_alike_ends_its_walk_early_and_beyond_the_points_held(monkeypatch):
    pick = random.Random(6)
    letters = [chr(0x4E00 + i) for i in range(400)]
    said = pick.choices(letters, k=3000)
    x = "".join(said)
    y, near = ("".join(c if pick.random() < share else pick.choice(letters) for c in said) for share in (0.7, 0.95))
    calls, full, whole = [], [], A.Anchors.longest

    class Counted(SequenceMatcher):
        def find_longest_match(self, *r):
            full.append(r)
            return super().find_longest_match(*r)

    wanted = [Counted(None, x, other).ratio() > 0.8 for other in (y, near)]
    monkeypatch.setattr(A.Anchors, "longest", lambda self, *r: calls.append(r) or whole(self, *r))
    assert [A.alike(x, other, 0.8) for other in (y, near)] == wanted == [False, True] and 2 <= len(calls) < 0.8 * len(full)
    monkeypatch.setattr(A, "POINTS", 0)
    assert [A.alike(x, other, 0.8) for other in (y, near)] == wanted


def test_a_filter_on_the_text_parses_pages_once(spark):
    pages = spark.createDataFrame([(1, "u", "<p>Fail to load page</p>"), (2, None, "<p>x</p>"), (3, "u", None)], "page_id long, url string, html string")
    valid = H.valid_pages(H.parsed_pages(pages)).select("page_id", "text")
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "PythonUDF" not in plan and "EvalPython" not in plan
    assert sorted((r.page_id, r.text) for r in valid.collect()) == [(2, "x"), (3, "")]


class Watched:
    """A column that notes how many rows are taken from it at once."""

    def __init__(self, column):
        self.column, self.taken = column, []

    def __len__(self):
        return len(self.column)

    def slice(self, at, n):
        self.taken.append(n)
        return self.column.slice(at, n)


def test_helpers_take_few_rows_at_once():
    values = ["a b", None, ""] * 200
    watched = Watched(pa.array(values))
    got = R.by_row(lambda t: None if t is None else t.split(), ArrayType(StringType())).func(watched)
    assert got.to_pylist() == [None if t is None else t.split() for t in values] and max(watched.taken) == R.SLICE < len(values)
    assert len(R.by_row(lambda t: t, StringType()).func(pa.array([], pa.string()))) == 0


def test_scores_on_token_numbers_equal_those_on_tokens():
    pick = random.Random(8)
    sides = [[pick.choices("abcdefg", k=pick.choice([0, 1, 3, 30])) for _ in range(300)] for _ in range(2)]
    watched = [Watched(pa.array(side, pa.list_(pa.string()))) for side in sides]

    def shared(a, b, n):
        grams = [[tuple(t[i:i + n]) for i in range(len(t) - n + 1)] for t in (a, b)]
        return sum(min(grams[0].count(g), grams[1].count(g)) for g in set(grams[0])), len(grams[0])

    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = list(itertools.accumulate(range(len(b)), lambda last, j, x=x, row=row: row[j] + 1 if b[j] == x else max(last, row[j + 1]), initial=0))
        return row[-1]

    counts = R.by_tokens(lambda a, b: [v for n in range(1, 5) for v in T._clipped(a, b, n)], ArrayType(LongType())).func(*watched)
    assert counts.to_pylist() == [[v for n in range(1, 5) for v in shared(a, b, n)] for a, b in zip(*sides)]
    assert max(watched[0].taken + watched[1].taken) == R.SLICE
    scores = R.by_tokens(T._rouge_l, DoubleType()).func(*watched)
    assert scores.to_pylist() == [2 * common(a, b) / (len(a) + len(b)) if common(a, b) else 0.0 for a, b in zip(*sides)]


def test_an_answer_map_makes_its_pairs_once(spark, apply):
    plan = spark.range(1).select(S.answer_map(F.col("id").cast("string")).alias("m"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("split(translate(") == 1
    assert apply(S.answer_map, "@a[1] @b[x:y], @a[2]", None) == [{"a": "2", "b": "xy"}, None]
