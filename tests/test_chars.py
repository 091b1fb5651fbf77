import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vacantia.operators import chars as C
from vacantia.sources import stored

TABLE = [("+", True), (",", False), (".", False), ("]", False), ("é", True), ("😀", False)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(TABLE, "ch string, is_word boolean").cache()


def normalised(spark, table, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = C.normalise_text(df, "text", table, **options).collect()
    return [r for r in sorted(rows, key=lambda r: r.i)]


CASES = {
    "abc123def": "abc def",
    "  a\t\n b  ": "a b",
    "c++, c.": "c++ c",
    "a,b.c]d": "a b c d",
    "café 1,2": "café",
    "naïve": "naïve",
    ",.": "",
    "": "",
    "a😀b": "a b",
    "a-b": "a-b",
    "12 34": "",
    "x_y": "x_y",
}


def test_normalise(spark, table):
    rows = normalised(spark, table, list(CASES) + [None])
    assert [r.text for r in rows] == [*CASES.values(), None]


def test_unknown_characters(spark, table):
    blanked = normalised(spark, table, ["a-b é", "naïve", "a+b"], unknown="blank")
    assert [r.text for r in blanked] == ["a b é", "na ve", "a+b"]
    flagged = normalised(spark, table, ["a-b é", "plain 1", "a+b, é", None], unknown="flag")
    assert [(r.text, r.has_unclassified) for r in flagged] == [
        ("a-b é", True), ("plain", False), ("a+b é", False), (None, None)]
    with pytest.raises(ValueError):
        normalised(spark, table, ["a"], unknown="ask")


def test_without_a_table(spark):
    empty = spark.createDataFrame([], "ch string, is_word boolean")
    assert [r.text for r in normalised(spark, empty, ["a,  b1"])] == ["a, b"]
    assert [r.text for r in normalised(spark, empty, ["a,b1"], unknown="blank")] == ["a b"]
    assert normalised(spark, empty, ["a,"], unknown="flag")[0].has_unclassified is True


def test_non_word_letters_count_only_next_to_special_characters(spark):
    table = spark.createDataFrame([("x", False)], "ch string, is_word boolean")
    assert [r.text for r in normalised(spark, table, ["axb", "axb!"])] == ["axb", "a b!"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet="ab1 ,.+é-]\t\n😀", max_size=30), min_size=1, max_size=40))
def test_normalise_against_character_loop_and_twice(spark, table, texts):
    drop = {ch for ch, word in TABLE if not word}

    def loop(text):
        kept = "".join(" " if c.isspace() or c.isdigit() or c in drop else c for c in text)
        return " ".join(kept.split())

    got = [r.text for r in normalised(spark, table, texts)]
    assert got == [loop(t) for t in texts]
    assert [r.text for r in normalised(spark, table, got)] == got


def test_report(spark, table):
    df = spark.createDataFrame([("a-b--+,",), ("ï 12_",), (None,), ("",)], "text string")
    got = {r.ch: r.n for r in C.unclassified_chars(df, "text", table).collect()}
    assert got == {"-": 3, "ï": 1}


def test_decisions(spark, table):
    decisions = spark.createDataFrame(
        [("-", "n", 1), ("-", "Yes", 2), ("+", "no", 1), ("/", "maybe", 1), ("é", "", 3),
         ("é", None, 4)],
        "ch string, answer string, decided_at int")
    got = {r.ch: r.is_word for r in C.apply_decisions(table, decisions).collect()}
    assert got == dict(TABLE) | {"-": True, "+": False}


def test_table_files(spark, table, tmp_path):
    path = str(tmp_path / "chars")
    assert stored.read_chars(spark, path).count() == 0
    stored.write_chars(table, path, 1)
    assert {tuple(r) for r in stored.read_chars(spark, path).collect()} == set(TABLE)
    stored.write_chars(stored.read_chars(spark, path).filter("is_word"), path, 2)
    assert {r.ch for r in stored.read_chars(spark, path).collect()} == {"+", "é"}
    text = str(tmp_path / "chars-text")
    stored.write_chars_text(table, text)
    assert {tuple(r) for r in stored.read_chars_text(spark, text).collect()} == set(TABLE)
